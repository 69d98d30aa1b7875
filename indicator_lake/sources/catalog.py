"""Catalog of the tables to load."""

from __future__ import annotations

import json
from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

FULL_SNAPSHOT = "full_snapshot"
SAMPLE_ONCE = "physical_sample_once"

# The tables of the public source. All are loaded whole; a catalog of one's own may ask for a sample
# by mode, ``sample_rows`` and ``sample_percent``.
DEFAULT_CATALOG = {
    "source_project": "basedosdados",
    "source_dataset": "br_inep_avaliacao_alfabetizacao",
    "sources": [
        {"name": "uf", "source_table": "uf", "destination_table": "uf", "mode": FULL_SNAPSHOT},
        {"name": "municipio", "source_table": "municipio", "destination_table": "municipio", "mode": FULL_SNAPSHOT},
        {
            "name": "alunos_amostra",
            "source_table": "alunos",
            "destination_table": "alunos_amostra",
            "mode": FULL_SNAPSHOT,
        },
        *(
            {"name": name, "source_table": name, "destination_table": name, "mode": FULL_SNAPSHOT}
            for name in (
                "meta_alfabetizacao_brasil",
                "meta_alfabetizacao_uf",
                "meta_alfabetizacao_municipio",
                "dicionario",
            )
        ),
    ],
    "external_sources": [
        {
            "name": "diretorio_municipio",
            "source_project": "basedosdados",
            "source_dataset": "br_bd_diretorios_brasil",
            "source_table": "municipio",
            "destination_table": "diretorio_municipio",
            "mode": FULL_SNAPSHOT,
        },
    ],
}


def load_catalog(path: str) -> dict:
    """Read a catalog file: JSON, or YAML where a YAML reader is installed."""
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as exc:
        raise ValueError("no YAML reader is installed; give the catalog as JSON") from exc
    return yaml.safe_load(text)


def build_source_list(catalog: Mapping) -> list[dict]:
    """One flat list: own sources inherit project and dataset, external ones bring theirs."""
    inherited = {key: catalog[key] for key in ("source_project", "source_dataset")}
    return [{**s, **inherited} for s in catalog.get("sources", [])] + [
        dict(s) for s in catalog.get("external_sources", [])
    ]


def select_sources(sources: Sequence[dict], only: Collection[str] | None = None) -> list[dict]:
    """Sources whose name is in ``only``; all of them without it."""
    return [s for s in sources if not only or s["name"] in only]


def source_name(source: Mapping) -> str:
    """Full dotted name, recorded with every loaded row."""
    return ".".join(source[k] for k in ("source_project", "source_dataset", "source_table"))


def parquet_reader(spark: SparkSession, root: str) -> Callable[[Mapping], DataFrame]:
    """Reader of ``root/project/dataset/table`` Parquet folders."""

    def read(source: Mapping) -> DataFrame:
        parts = [source[k] for k in ("source_project", "source_dataset", "source_table")]
        return spark.read.parquet("/".join([root, *parts]))

    return read


def preflight(sources: Sequence[Mapping], read: Callable[[Mapping], DataFrame]) -> DataFrame:
    """One row per readable, non-empty source; fails if a source cannot be opened."""
    probes = [
        read(s).select(F.lit(s["name"]).alias("name"), F.lit(1).alias("acesso_ok")).limit(1) for s in sources
    ]
    out = probes[0]
    for probe in probes[1:]:
        out = out.union(probe)
    return out


def catalog_counts(sources: Sequence[Mapping], read: Callable[[Mapping], DataFrame]) -> DataFrame:
    """Rows and columns of every source."""
    counts = []
    for s in sources:
        df = read(s)
        counts.append(
            df.agg(F.count("*").alias("n_rows")).select(
                F.lit(s["name"]).alias("name"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns")
            )
        )
    out = counts[0]
    for count in counts[1:]:
        out = out.union(count)
    return out
