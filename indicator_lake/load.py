"""Load the tables of a catalog from the command line: ``spark-submit`` this file or ``python -m indicator_lake.load``."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from indicator_lake.session import build_session
from indicator_lake.sources.catalog import DEFAULT_CATALOG, build_source_list, load_catalog, parquet_reader, preflight, select_sources
from indicator_lake.sources.loader import Loader, LoadFailure

LOGGER = logging.getLogger(__name__)


def arguments(words: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="indicator_lake.load", description="Load catalog sources into snapshot tables.")
    parser.add_argument("--landing", required=True, help="folder that holds project/dataset/table Parquet folders")
    parser.add_argument("--bronze", required=True, help="folder of the snapshot tables")
    parser.add_argument("--config", help="catalog file (JSON, or YAML where a reader is installed); default: the public source")
    parser.add_argument("--only", nargs="+", metavar="NAME", help="load these sources of the catalog alone")
    parser.add_argument("--export", metavar="FOLDER", help="also write each loaded run there")
    parser.add_argument("--audit", metavar="FOLDER", help="audit table of runs (default: _audit/runs below --bronze)")
    parser.add_argument("--run-id", help="id of the run; repeating one replaces its rows (default: a new one)")
    parser.add_argument("--force-refresh-sample", action="store_true", help="draw samples again that were drawn already")
    parser.add_argument("--check", action="store_true", help="only see whether every source can be read")
    return parser.parse_args(words)


def run(spark: SparkSession, asked: argparse.Namespace) -> int:
    """Exit code: 0, or 1 when a table could not be loaded or, with ``--check``, read; 2 for an unknown name."""
    sources = build_source_list(load_catalog(asked.config) if asked.config else DEFAULT_CATALOG)
    unknown = sorted(set(asked.only or ()) - {s["name"] for s in sources})
    if unknown:
        LOGGER.error("the catalog has no source named %s", ", ".join(unknown))
        return 2
    read = parquet_reader(spark, asked.landing)
    if asked.check:
        readable = True
        for source in select_sources(sources, asked.only):
            try:
                found = preflight([source], read).count() > 0
            except Exception as exc:  # noqa: BLE001 - the next source is looked at all the same
                found = False
                LOGGER.error("%s: %s", source["name"], exc)
            print(f"{source['name']}: {'ok' if found else 'not readable or empty'}")
            readable &= found
        return 0 if readable else 1
    options = {"run_id": asked.run_id} if asked.run_id else {}
    load = Loader(
        spark, asked.bronze, read, export_root=asked.export, audit_path=asked.audit or f"{asked.bronze}/_audit/runs",
        force_refresh_sample=asked.force_refresh_sample, **options,
    )
    try:
        rows = load.run(sources, only=asked.only).collect()
    except LoadFailure as failure:
        LOGGER.error("%s", failure)
        return 1
    for row in rows:
        print(f"{row.destination_table}: {row.rows_processed} rows in {row.duration_seconds:.1f} s")
    return 0


def main(words: Sequence[str] | None = None) -> int:
    asked = arguments(words)
    spark = build_session("indicator-load")
    try:
        return run(spark, asked)
    finally:
        spark.stop()


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    raise SystemExit(main())
