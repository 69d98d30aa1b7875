"""Refresh of the cleaned events and the municipal indicator that costs what changed.

What was read is kept with the commits: the run of each source and the last micro-batch of each stream. A refresh
takes the newer ones, finds the (year, municipality) pairs they touch, recomputes the indicator rows of these pairs from
their own inputs with the same functions as the full run, and replaces the cells they lie in.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from indicator_lake.operators.picks import INGESTED_AT, RUN_ID, keep_latest
from indicator_lake.plans import gold, silver
from indicator_lake.sources import commits
from indicator_lake.sources.cells import cells_of, changed_keys, matching, read_cells, replace_cells
from indicator_lake.sources.tables import Snapshots, read_if_present, stage
from indicator_lake.streaming import sinks

BUCKETS = 16  # cells of a year, unless told otherwise
STAMPS = (INGESTED_AT, RUN_ID, "_processed_at")
PAIR = ("ano", "id_municipio")
# Cleaned table: its function, source table and sort columns.
CLEANED = {
    "dim_municipio": (silver.dim_municipio, "diretorio_municipio", ("sigla_uf", "id_municipio")),
    "municipio_resultado": (silver.municipio_resultado, "municipio", ("ano", "id_municipio", "rede")),
    "meta_municipio": (silver.meta_municipio, "meta_alfabetizacao_municipio", ("ano_meta", "id_municipio", "rede")),
}


def _day() -> Column:
    return F.to_date("data_evento").cast("string")


def _pair_cell(year: str, buckets: int) -> Column:
    return F.concat_ws("-", F.col(year).cast("string"), F.pmod(F.xxhash64("id_municipio"), F.lit(buckets)).cast("string"))


def refresh_cleaned(spark: SparkSession, bronze: Mapping[str, Snapshots], root: str, name: str, processed_at: Column | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(the cleaned table, its version before), rewritten only if its source has a newer run; (table, None) if unchanged."""
    build, source, order = CLEANED[name]
    path = f"{root}/silver/{name}"
    marks = commits.runs(spark, bronze[source].path)
    newest = marks[-1].run_id if marks else None
    before, state = read_if_present(spark, path), commits.live(spark, path)
    if state is not None and newest is not None and state.extra.get("run") == [newest, marks[-1].stamp]:
        return before, None
    staged = stage(build(bronze[source], processed_at), path, order)
    now = staged.publish({"run": [newest, marks[-1].stamp]} if marks else {})
    return now, now.limit(0) if before is None else before


def refresh_events(spark: SparkSession, events_root: str, root: str, checkpoint: str | None = None) -> DataFrame | None:
    """Bring the cleaned events up to date with the stream; returns the (year, municipality) pairs that changed.

    Only days with a new event, or with an earlier delivery of one, are rewritten. None when nothing is new.
    """
    path = f"{root}/silver/eventos_indicador_tratados"
    state = commits.live(spark, path)
    new, upto = sinks.events_since(spark, events_root, state.extra["consumed"] if state else {}, checkpoint)
    if new is None:
        return None
    fresh = silver.eventos_indicador_tratados(new)
    if state is None:
        replace_cells(fresh, path, _day(), None, {"consumed": upto})
        return fresh.select(*PAIR).distinct()
    stored = read_cells(spark, path)
    again = matching(stored.select("id_evento", "data_evento", *PAIR), fresh, {"id_evento": "id_evento"})
    days = cells_of(fresh.select("data_evento").unionByName(again.select("data_evento")), _day())
    rows = read_cells(spark, path, days).unionByName(fresh)
    replace_cells(keep_latest(rows, ["id_evento"], ["data_processamento"]), path, _day(), days, {"consumed": upto})
    return fresh.select(*PAIR).unionByName(again.select(*PAIR)).distinct()


def _touched(cleaned: Mapping[str, tuple[DataFrame, DataFrame | None]], events: DataFrame, event_pairs: DataFrame | None) -> list[DataFrame]:
    """(year, municipality) pairs touched by each input that changed."""
    found = [] if event_pairs is None else [event_pairs]
    results, old_results = cleaned["municipio_resultado"]
    if old_results is not None:
        found.append(changed_keys(old_results, results, PAIR, STAMPS))
    targets, old_targets = cleaned["meta_municipio"]
    if old_targets is not None:
        keys = changed_keys(old_targets, targets, ("ano_resultado", "ano_meta", "id_municipio"), STAMPS)
        found.append(keys.select(F.explode(F.array("ano_resultado", "ano_meta")).alias("ano"), "id_municipio"))
    directory, old_directory = cleaned["dim_municipio"]
    if old_directory is not None:
        places = changed_keys(old_directory, directory, ("id_municipio",), STAMPS)
        for rows in (results, events):
            found.append(matching(rows.select(*PAIR), places, {"id_municipio": "id_municipio"}))
    return found


def _written(df: DataFrame, path: str) -> DataFrame:
    """The rows from files beside a table's: they are asked for several times. No commit names them, so they go after the grace time."""
    folder = f"{path}/{commits.new_folder()}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def refresh_indicator(
    spark: SparkSession,
    bronze: Mapping[str, Snapshots],
    events_root: str,
    root: str,
    checkpoint: str | None = None,
    stamp: Column | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The municipal indicator, brought up to date with new runs and new events; equal to a full run but for stamps.

    A year's rows lie in ``buckets`` cells: many make a refresh rewrite less, few make fewer files.
    Rows that nothing touched keep the time stamps they had. If the refresh is stopped between its steps, the next
    one finds inputs newer than the indicator has seen and rebuilds it whole.
    """
    cleaned = {name: refresh_cleaned(spark, bronze, root, name, stamp) for name in CLEANED}
    event_pairs = refresh_events(spark, events_root, root, checkpoint)
    path = f"{root}/gold/indicador_municipio"
    events = read_cells(spark, f"{root}/silver/eventos_indicador_tratados")
    if events is None:
        raise ValueError(f"no finished micro-batch below {events_root}")
    seen = {name: commits.live(spark, f"{root}/silver/{name}").number for name in (*CLEANED, "eventos_indicador_tratados")}
    state, changed = commits.live(spark, path), [n for n, (_, old) in cleaned.items() if old is not None]
    tables = {name: now for name, (now, _) in cleaned.items()}
    steps = {**dict.fromkeys(seen, 0), **dict.fromkeys(changed, 1), "eventos_indicador_tratados": int(event_pairs is not None)}
    current = state is not None and state.extra["seen"] == {n: seen[n] - steps[n] for n in seen} and state.extra["buckets"] == buckets
    cell = _pair_cell("ano_resultado", buckets)
    if not current:
        rows = gold.indicador_municipio(tables["municipio_resultado"], tables["meta_municipio"], tables["dim_municipio"], events, stamp)
        replace_cells(rows, path, cell, None, {"seen": seen, "buckets": buckets})
        return read_cells(spark, path)
    touched = _touched(cleaned, events, event_pairs)
    if not touched:
        return read_cells(spark, path)
    pairs = _written(reduce(DataFrame.unionByName, touched).distinct(), path)
    places = pairs.select("id_municipio").distinct()
    by_pair, by_place = {"ano": "ano", "id_municipio": "id_municipio"}, {"id_municipio": "id_municipio"}
    rows = gold.indicador_municipio(
        matching(tables["municipio_resultado"], pairs, by_pair),
        matching(tables["meta_municipio"], places, by_place),
        matching(tables["dim_municipio"], places, by_place),
        matching(events, pairs, by_pair),
        stamp,
    )
    cells = cells_of(pairs, _pair_cell("ano", buckets))
    kept = matching(read_cells(spark, path, cells), pairs, {"ano_resultado": "ano", "id_municipio": "id_municipio"}, "left_anti")
    replace_cells(rows, path, cell, cells, {"seen": seen, "buckets": buckets}, kept)
    return read_cells(spark, path)
