"""Indicator inputs derived from the driver's tables.

Each input is one portable SQL text that Spark and DuckDB read alike, so a proof compares only
the operators built on it. Suppliers play municipalities, nations states, regions great regions;
line items play students, and their aggregates results and targets. All inputs grow with the
tables. Source tables hold three copies of every row: an older run that must vanish, and two
rows per key in the newest run, of which the later one must win.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from indicator_lake.operators.reshape import TARGET_YEARS
from indicator_lake.session import pieces, work_folder
from indicator_lake.sources.commits import Files
from indicator_lake.streaming.contract import STATE_CODES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
STATES = "".join(STATE_CODES)
# Events are dealt to tasks by this much of their table: a message takes long to build and read, and a file may
# hold few row groups.
EVENT_BYTES_PER_TASK = 2 << 20
AS_OF = "2024-01-25 00:00:00"
PROCESSED_AT = "2024-03-01 00:00:00"

# Words that differ between the two SQL dialects.
SPARK = {
    "copies": "LATERAL VIEW explode(array(1, 2, 3)) c AS copia",
    "iso": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")",
    "epoch": "unix_seconds(cast(ts AS timestamp))",
}
DUCKDB = {
    "copies": ", unnest([1, 2, 3]) AS c(copia)",
    "iso": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')",
    "epoch": "cast(floor(epoch(ts)) AS bigint)",
}

LINEAGE = """
  CASE WHEN copia = 1 THEN timestamp '2024-01-01 00:00:00'
       WHEN copia = 2 THEN timestamp '2024-02-01 00:00:00'
       ELSE timestamp '2024-02-01 00:05:00' END AS _ingested_at,
  CASE WHEN copia = 1 THEN 'run-1' ELSE 'run-2' END AS _ingestion_run_id"""

NETWORK = "CASE WHEN l_linestatus = 'F' THEN ' Municipal ' ELSE 'ESTADUAL' END"


def _targets(place: str) -> str:
    """Wide target columns from the group size ``n``; some are missing, some groups have none."""
    metas = [
        f"CASE WHEN copia = 1 THEN '1' WHEN n % 13 = 0 OR (n + {y}) % 5 = 0 THEN NULL "
        f"ELSE cast(20 + 3 * ({y} - 2024) + n % 7 AS string) END AS meta_alfabetizacao_{y}"
        for y in TARGET_YEARS
    ]
    return f"""
  cast(ano AS string) AS ano, {place} rede,
  CASE WHEN n % 3 = 0 THEN 'n/d' ELSE cast(100e0 * n_r / n AS string) END AS taxa_alfabetizacao,
  cast(100e0 * n_q / n AS string) AS percentual_participacao,
  cast(n % 4 + CASE WHEN copia = 2 THEN 9 ELSE 0 END AS string) AS nivel_alfabetizacao,
  {", ".join(metas)}, {LINEAGE}"""


def _result(place: str) -> str:
    shares = [f"cast(100e0 * n_{k} / n AS string) AS proporcao_aluno_nivel_{k}" for k in range(9)]
    return f"""
  cast(ano AS string) AS ano, {place} serie, rede,
  CASE WHEN copia = 1 THEN '0' WHEN copia = 2 THEN '99' WHEN n = 1 THEN 'n/d'
       ELSE cast(100e0 * n_r / n AS string) END AS taxa_alfabetizacao,
  cast(cents / 1e5 / n AS string) AS media_portugues,
  {", ".join(shares)}, {LINEAGE}"""


_GROUPED = """
  year(l_shipdate) + 29 AS ano, cast(count(*) AS bigint) AS n,
  cast(count_if(l_returnflag = 'R') AS bigint) AS n_r,
  cast(count_if(l_quantity >= 10) AS bigint) AS n_q,
  cast(sum(cast(round(l_extendedprice * 100) AS bigint)) AS bigint) AS cents,
  """ + ",\n  ".join(
    f"cast(count_if(cast(round(l_tax * 100) AS int) = {k}) AS bigint) AS n_{k}" for k in range(9)
)
_GRADE = "' Ano ' || cast(l_linenumber AS string)"
_STATE = f"' ' || lower(substr('{STATES}', 2 * s_nationkey + 1, 2)) || chr(9)"

INPUTS = {
    # Municipality directory: codes without padding, ragged labels; the newest run lacks
    # municipalities with a negative balance.
    "b_directory": f"""
SELECT cast(s_suppkey AS string) AS id_municipio,
  CASE WHEN copia = 1 THEN 'Antigo ' || s_name WHEN copia = 2 THEN upper(s_name)
       ELSE '  ' || s_name || chr(9) END AS nome,
  {_STATE} AS sigla_uf, n_name AS nome_uf, r_name AS regiao,
  cast(s_nationkey * 100 + s_suppkey % 100 AS string) AS id_microrregiao,
  cast(s_nationkey AS string) AS id_mesorregiao, {LINEAGE}
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey
  JOIN {{region}} ON n_regionkey = r_regionkey {{copies}}
WHERE copia = 1 OR s_acctbal >= 0""",
    "b_group_municipio": f"""
SELECT l_suppkey, l_linenumber, {_GRADE} AS serie, {NETWORK} AS rede, {_GROUPED}
FROM {{lineitem}} GROUP BY year(l_shipdate), l_suppkey, l_linenumber, l_linestatus""",
    "b_group_uf": f"""
SELECT {_STATE} AS sigla_uf, {_GRADE} AS serie, {NETWORK} AS rede, {_GROUPED}
FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey
GROUP BY year(l_shipdate), s_nationkey, l_linenumber, l_linestatus""",
    "b_municipio": f"SELECT {_result('cast(l_suppkey AS string) AS id_municipio,')} FROM {{b_group_municipio}} {{copies}}",
    "b_uf": f"SELECT {_result('sigla_uf,')} FROM {{b_group_uf}} {{copies}}",
    "b_group_meta_municipio": f"""
SELECT l_suppkey, {NETWORK} AS rede, {_GROUPED}
FROM {{lineitem}} GROUP BY year(l_shipdate), l_suppkey, l_linestatus""",
    "b_group_meta_uf": f"""
SELECT {_STATE} AS sigla_uf, {NETWORK} AS rede, {_GROUPED}
FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey
GROUP BY year(l_shipdate), s_nationkey, l_linestatus""",
    "b_group_meta_brasil": f"""
SELECT {NETWORK} AS rede, {_GROUPED} FROM {{lineitem}} GROUP BY year(l_shipdate), l_linestatus""",
    "b_meta_municipio": f"SELECT {_targets('cast(l_suppkey AS string) AS id_municipio,')} FROM {{b_group_meta_municipio}} {{copies}}",
    "b_meta_uf": f"SELECT {_targets('sigla_uf,')} FROM {{b_group_meta_uf}} {{copies}}",
    "b_meta_brasil": f"SELECT {_targets('')} FROM {{b_group_meta_brasil}} {{copies}}",
    # Students: line items repeat their key, so the key is not unique inside a run either.
    "b_students": f"""
SELECT cast(year(l_shipdate) + 29 AS string) AS ano, cast(l_suppkey AS string) AS id_municipio,
  cast(l_partkey AS string) AS id_escola,
  cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) AS id_aluno,
  l_returnflag AS caderno, {_GRADE} AS serie, {NETWORK} AS rede,
  CASE WHEN l_tax > 0.015 THEN ' Presente ' ELSE 'AUSENTE' END AS presenca,
  l_linestatus AS preenchimento_caderno,
  CASE WHEN copia = 1 THEN 'x' WHEN l_returnflag = 'A' THEN ' Sim ' WHEN l_returnflag = 'N' THEN 'NÃO'
       ELSE '?' END AS alfabetizado,
  cast(cast(round(l_extendedprice * 100) AS bigint) AS string) AS proficiencia,
  CASE WHEN l_discount < 0.005 THEN NULL ELSE cast(l_quantity AS string) END AS peso_aluno, {LINEAGE}
FROM {{lineitem}} {{copies}}""",
    # Snapshot runs: one run per order year.
    "b_runs": """
SELECT *, 'run-' || cast(year(o_orderdate) AS string) AS _ingestion_run_id,
  cast(date_trunc('year', o_orderdate) AS timestamp) AS _ingested_at
FROM {orders}""",
    # Event messages: JSON text; the number ``k`` in the event's props decides which messages
    # break which rule of the contract, and values above 100 or late times break it by nature.
    "b_events": f"""
SELECT event_id, ts, user_id, event_type, value, cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k,
  coalesce(substr('{STATES}', 2 * s_nationkey + 1, 2), 'PE') AS uf
FROM {{events}} LEFT JOIN {{supplier}} ON user_id = s_suppkey""",
    "b_messages": """
SELECT cast(event_id AS string) AS message_id, CASE
  WHEN k = 3 THEN '{"id_evento": "evt-' || cast(event_id AS string)
  WHEN k = 7 THEN '[' || cast(event_id AS string) || ']'
  ELSE '{"id_evento": "evt-' || cast(event_id AS string) || '", "id_municipio": ' ||
    CASE WHEN k = 0 THEN '"123"' WHEN k = 6 THEN cast(1000000 + user_id AS string)
         ELSE '"' || lpad(cast(user_id AS string), 7, '0') || '"' END ||
    ', "sigla_uf": "' || CASE WHEN k = 1 THEN 'XX' WHEN k BETWEEN 20 AND 24 THEN 'sp'
         ELSE ' ' || lower(uf) || ' ' END || '"' ||
    ', "ano": ' || CASE WHEN k = 8 THEN '2036' WHEN k = 9 THEN '2025.5' WHEN k = 14 THEN '"2025"'
         ELSE cast(2023 + k % 13 AS string) END ||
    CASE WHEN k = 5 THEN '' ELSE ', "rede": "' ||
         CASE WHEN event_type IN ('view', 'click') THEN 'Municipal' ELSE 'estadual' END || '"' END ||
    ', "serie": "ANO ' || CASE event_type WHEN 'view' THEN '1' WHEN 'click' THEN '2' WHEN 'signup' THEN '3'
         WHEN 'purchase' THEN '4' ELSE '5' END || '"' ||
    ', "taxa_alfabetizacao": ' || CASE WHEN k = 10 THEN '"' || cast(value AS string) || '"'
         WHEN k = 15 THEN 'null' ELSE cast(value AS string) END ||
    CASE WHEN k < 40 THEN '' WHEN k < 60 THEN ', "meta_alfabetizacao": null'
         WHEN k = 60 THEN ', "meta_alfabetizacao": -1'
         ELSE ', "meta_alfabetizacao": ' || cast(20 + k % 40 AS string) END ||
    CASE WHEN k = 30 THEN ', "tipo_evento": 5' WHEN k = 31 THEN ', "tipo_evento": "CORRECAO"' ELSE '' END ||
    CASE WHEN k = 32 THEN ', "fonte": null' WHEN k = 33 THEN ', "fonte": "API"' ELSE '' END ||
    CASE WHEN k = 2 THEN ', "nome_aluno": "x"' ELSE '' END ||
    ', "data_evento": ' || CASE WHEN k = 4 THEN '"2999-01-01T00:00:00+00:00"' WHEN k = 11 THEN '"ontem"'
         WHEN k = 13 THEN cast({epoch} AS string)
         WHEN k % 2 = 0 THEN '"' || {iso} || '+00:00"' ELSE '"' || {iso} || '"' END || '}'
  END AS value
FROM {b_events}""",
}

# Spark counts the line items once, in cells as fine as the finest group, and stores the cells: every source, the search
# for its newest run and each further use of it would otherwise scan and shuffle the line items again. Coarser groups
# add up the cells, which gives the same rows as counting line items.
CELLS = "b_cells"
_YEAR = "year(l_shipdate)"
_MEASURES = ("n", "n_r", "n_q", "cents", *[f"n_{k}" for k in range(9)])
_ADDED = "\n  l_year + 29 AS ano, " + ", ".join(f"cast(sum({m}) AS bigint) AS {m}" for m in _MEASURES)
SPARK_TEXTS = {
    name: text.replace(_GROUPED, _ADDED).replace(_YEAR, "l_year").replace("{lineitem}", f"{{{CELLS}}}")
    for name, text in INPUTS.items()
    if _GROUPED in text
}
SPARK_TEXTS |= {
    CELLS: f"""
SELECT {_YEAR} AS l_year, l_suppkey, l_linenumber, l_linestatus, {_GROUPED}
FROM {{lineitem}} GROUP BY {_YEAR}, l_suppkey, l_linenumber, l_linestatus""",
    "b_group_municipio": f"""
SELECT l_suppkey, l_linenumber, {_GRADE} AS serie, {NETWORK} AS rede, ano, {", ".join(_MEASURES)}
FROM {{{CELLS}}}""",
}

# Braces of the JSON text are not placeholders.
_WORD = re.compile(r"\{(\w+)\}")


def needed(name: str) -> list[str]:
    """Inputs that ``name`` is built from, dependencies first, itself last."""
    out: list[str] = []
    for word in _WORD.findall(INPUTS[name]):
        if word in INPUTS:
            out += [n for n in needed(word) if n not in out]
    return [*out, name]


def duckdb_text(name: str) -> str:
    return _WORD.sub(lambda m: DUCKDB.get(m[1], m[1]), INPUTS[name])


class Inputs:
    """The driver's tables and the inputs derived from them as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            derived = name in INPUTS or name in SPARK_TEXTS
            self._built[name] = self._derive(name) if derived else self.table(name)
        return self._built[name]

    def size(self, *names: str) -> int:
        """Stored bytes of some of the driver's tables."""
        files = Files(self.spark, self.sf_dir)
        return sum(files.size(f"{name}.parquet") for name in names)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _dealt_events(self) -> DataFrame:
        tasks, events = pieces(self.size("events"), EVENT_BYTES_PER_TASK), self["events"]
        return events.repartition(tasks, "event_id") if tasks > 1 else events

    def _derive(self, name: str) -> DataFrame:
        frames = {}
        text = SPARK_TEXTS.get(name) or INPUTS[name]
        for word in dict.fromkeys(_WORD.findall(text)):
            if word not in SPARK:
                frames[word] = self._dealt_events() if word == "events" else self[word]
        # Double the braces of the JSON text; ``spark.sql`` fills the remaining names with frames.
        text = _WORD.sub(lambda m: SPARK.get(m[1], f"\0{m[1]}\1"), text)
        text = text.replace("{", "{{").replace("}", "}}").replace("\0", "{").replace("\1", "}")
        derived = self.spark.sql(text, **frames)
        return self._stored(derived, name) if name == CELLS else derived

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = work_folder(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
