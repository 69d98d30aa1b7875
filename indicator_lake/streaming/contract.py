"""Event contract: parse messages, name the broken rules, shape accepted and rejected rows.

Input has ``value`` (message body, binary or text) and ``message_id``. Everything is a native
column expression, so the same functions serve static and streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from indicator_lake.functions.normalise import CODE_PATTERN, WHITE_SPACE, trim_ws

# The 27 state codes, bounds, defaults and field names of the contract.
STATE_CODES = (
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO",
    "MA", "MT", "MS", "MG", "PA", "PB", "PR", "PE", "PI",
    "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
)
FIRST_YEAR, LAST_YEAR = 2023, 2035
LOWEST_RATE, HIGHEST_RATE = 0, 100
DEFAULTS = {"tipo_evento": "ATUALIZACAO_INDICADOR", "fonte": "SIMULADOR_TECH_CHALLENGE"}
FIELDS = (
    "id_evento", "id_municipio", "sigla_uf", "ano", "rede", "serie", "taxa_alfabetizacao",
    "meta_alfabetizacao", "tipo_evento", "fonte", "data_evento",
)
NOT_AN_OBJECT = "json_object"
# White space that event text is stripped of: also the four ASCII separators.
_STRIPPED = WHITE_SPACE + "\x1c\x1d\x1e\x1f"
_INTEGERS = ("TINYINT", "SMALLINT", "INT", "BIGINT")
_ISO_TIME = (
    r"^\d{4}-\d{2}-\d{2}([Tt _]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?"
    r"\s?([Zz]|[+-]\d{2}:?\d{2})?)?\z"
)
# Epoch numbers beyond this many seconds are read as milliseconds.
_SECONDS_LIMIT = 20_000_000_000


@dataclass(frozen=True)
class Contract:
    states: Sequence[str] = STATE_CODES
    years: tuple[int, int] = (FIRST_YEAR, LAST_YEAR)
    rates: tuple[float, float] = (LOWEST_RATE, HIGHEST_RATE)


def parse(messages: DataFrame) -> DataFrame:
    """Add ``_text`` (body, invalid bytes replaced) and ``_body`` (its JSON object or NULL)."""
    raw = F.col("value").cast("string")
    return messages.withColumns(
        {
            "_text": F.make_valid_utf8(raw),
            "_body": F.when(F.is_valid_utf8(raw), F.try_parse_json(raw)).try_cast("map<string,variant>"),
        }
    )


def _kind(name: str) -> Column:
    """JSON type of a field (STRING, BIGINT, DECIMAL(..), DOUBLE, BOOLEAN, VOID, ..); VOID when absent."""
    return F.col(f"_kind_{name}")


def _raw(name: str) -> Column:
    """A scalar field as text."""
    return F.col(f"_raw_{name}")


def _text(name: str) -> Column:
    return F.when(_kind(name) == "STRING", _raw(name))


# Numbers written as text; casts alone would also take suffixes and hexadecimal forms.
_DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"
_WHOLE = r"^\s*[+-]?[0-9]+(\.0+)?\s*\z"
_PLAIN = r"^\s*[+-]?[0-9]+(\.[0-9]+)?\s*\z"


def _number(name: str, written: str = _DECIMAL) -> Column:
    """A JSON number, true/false as 1/0, or a number written as text in the form ``written``."""
    kind = _kind(name)
    numeric = kind.isin(*_INTEGERS, "FLOAT", "DOUBLE") | kind.startswith("DECIMAL")
    numeric = numeric | ((kind == "STRING") & _raw(name).rlike(written))
    flag = F.when(kind == "BOOLEAN", _raw(name).try_cast("boolean").cast("double"))
    return F.when(numeric, _raw(name).try_cast("double")).otherwise(flag)


def _instant(name: str) -> Column:
    """ISO text (without offset = session time zone, UTC) or an epoch number."""
    text = F.translate(_text(name), "t_z,", "T Z.")
    number = F.when(_kind(name) != "BOOLEAN", _number(name, _PLAIN))
    seconds = F.when(F.abs(number) > _SECONDS_LIMIT, number / 1000).otherwise(number)
    epoch = F.timestamp_micros(F.round(seconds * 1_000_000).try_cast("bigint"))
    return F.when(text.rlike(_ISO_TIME), text.try_cast("timestamp")).otherwise(epoch)


def _outside(value: Column, bounds: tuple[float, float]) -> Column:
    return ~F.coalesce(value.between(*bounds), F.lit(False))


def _not_text(name: str) -> Column:
    """TRUE when present with anything but text."""
    present = F.array_contains(F.col("_keys"), name)
    return F.coalesce(present, F.lit(False)) & (_kind(name) != "STRING")


def typed(parsed: DataFrame) -> DataFrame:
    """One ``_<field>`` column of the field's type per field, and what the rules ask of the body.

    Type and text of a field are taken from the body once. The columns come out of a generator,
    so filters on the rules stay above it instead of repeating the parsing for every use.
    """
    found = {}
    for name in FIELDS:
        found[f"_kind_{name}"] = F.coalesce(F.schema_of_variant(F.col("_body")[name]), F.lit("VOID"))
        found[f"_raw_{name}"] = F.col("_body")[name].try_cast("string")
    parsed = parsed.withColumns({**found, "_keys": F.map_keys("_body")})
    columns = {
        "_is_object": F.col("_body").isNotNull(),
        "_extra_field": F.size(F.array_except(F.col("_keys"), F.array(*map(F.lit, FIELDS)))) > 0,
        "_id_evento": _text("id_evento"),
        "_id_municipio": _text("id_municipio"),
        "_sigla_uf": F.upper(trim_ws(_text("sigla_uf"), _STRIPPED)),
        "_ano": _number("ano", _WHOLE),
        "_rede": _text("rede"),
        "_serie": _text("serie"),
        "_taxa_alfabetizacao": _number("taxa_alfabetizacao"),
        "_meta_alfabetizacao": _number("meta_alfabetizacao"),
        "_has_meta": _kind("meta_alfabetizacao") != "VOID",
        "_tipo_evento": _text("tipo_evento"),
        "_tipo_evento_not_text": _not_text("tipo_evento"),
        "_fonte": _text("fonte"),
        "_fonte_not_text": _not_text("fonte"),
        "_data_evento": _instant("data_evento"),
    }
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return parsed.select("message_id", "_text", F.inline(F.array(row)))


def rules(contract: Contract, as_of: Column) -> dict[str, Column]:
    """Rule name -> condition that is TRUE when the message breaks it (never NULL)."""

    def empty(name: str) -> Column:
        return F.coalesce(F.length(f"_{name}"), F.lit(0)) < 1

    year, code = F.col("_ano"), F.col("_id_municipio")
    return {
        "extra_field": F.coalesce(F.col("_extra_field"), F.lit(False)),
        "id_evento": empty("id_evento"),
        "id_municipio": ~F.coalesce(code.rlike(CODE_PATTERN), F.lit(False)),
        "sigla_uf": ~F.coalesce(F.col("_sigla_uf").isin(*contract.states), F.lit(False)),
        "ano": _outside(F.when(year == F.floor(year), year), contract.years),
        "rede": empty("rede"),
        "serie": empty("serie"),
        "taxa_alfabetizacao": _outside(F.col("_taxa_alfabetizacao"), contract.rates),
        "meta_alfabetizacao": F.col("_has_meta") & _outside(F.col("_meta_alfabetizacao"), contract.rates),
        "tipo_evento": F.col("_tipo_evento_not_text"),
        "fonte": F.col("_fonte_not_text"),
        "data_evento": F.coalesce(F.col("_data_evento") > as_of, F.lit(True)),
    }


def validate(messages: DataFrame, contract: Contract = Contract(), as_of: Column | None = None) -> DataFrame:
    """Add ``_errors``: names of the broken rules in contract order, empty when accepted.

    ``as_of`` is the moment after which an event lies in the future (default: now).
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    checked = typed(parse(messages))
    broken = [F.when(condition, F.lit(name)) for name, condition in rules(contract, as_of).items()]
    errors = F.when(~F.col("_is_object"), F.array(F.lit(NOT_AN_OBJECT))).otherwise(
        F.array_compact(F.array(*broken))
    )
    return checked.withColumn("_errors", errors)


def accepted(validated: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Rows of the valid-event table."""
    stamp = F.current_timestamp() if processed_at is None else processed_at
    return validated.where(F.size("_errors") == 0).select(
        F.col("_id_evento").alias("id_evento"),
        F.col("_id_municipio").alias("id_municipio"),
        F.col("_sigla_uf").alias("sigla_uf"),
        F.col("_ano").cast("bigint").alias("ano"),
        F.col("_rede").alias("rede"),
        F.col("_serie").alias("serie"),
        F.col("_taxa_alfabetizacao").alias("taxa_alfabetizacao"),
        F.col("_meta_alfabetizacao").alias("meta_alfabetizacao"),
        *[F.coalesce(F.col(f"_{name}"), F.lit(text)).alias(name) for name, text in DEFAULTS.items()],
        F.col("_data_evento").alias("data_evento"),
        stamp.alias("data_processamento"),
        F.col("message_id").alias("pubsub_message_id"),
    )


def rejected(validated: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Rows of the dead-letter table: the whole payload and the names of the broken rules."""
    stamp = F.current_timestamp() if processed_at is None else processed_at
    return validated.where(F.size("_errors") > 0).select(
        F.col("_text").alias("payload"),
        F.concat_ws("; ", "_errors").alias("error_message"),
        stamp.alias("data_processamento"),
        F.col("message_id").alias("pubsub_message_id"),
    )
