"""One query per operator, built from the package's operators on the derived inputs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone
from functools import cached_property

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from indicator_lake.functions import measures, normalise
from indicator_lake.operators import joins, picks, quality, ranking
from indicator_lake.plans import colocated, dashboards, gold, lakehouse, refresh, served, silver
from indicator_lake.session import apply_settings, pieces, size_tasks, work_folder
from indicator_lake.sources import catalog, commits, loader, tables
from indicator_lake.streaming import contract, sinks
from proofs.inputs import AS_OF, PROCESSED_AT, TABLES, Inputs

# A bucket is one task when it is read, so their number follows the input; so does that of the message files.
INPUT_BYTES_PER_BUCKET = 8 << 20
EVENT_BYTES_PER_FILE = 2 << 20

QUERIES: dict[str, Callable[[Lake], DataFrame]] = {}


def proof(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def stamp(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def shown(name: str) -> Column:
    """A timestamp as text with six fraction digits."""
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


class Lake:
    """The inputs and every dataset built from them, lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = apply_settings(spark)
        self.inputs = Inputs(spark, sf_dir)
        size_tasks(spark, self.inputs.size(*TABLES))

    def folder(self, label: str) -> str:
        return work_folder(self.spark, label)

    @cached_property
    def dim(self) -> DataFrame:
        return silver.dim_municipio(self.inputs["b_directory"], stamp(PROCESSED_AT))

    @cached_property
    def results(self) -> DataFrame:
        return silver.municipio_resultado(self.inputs["b_municipio"], stamp(PROCESSED_AT))

    @cached_property
    def state_results(self) -> DataFrame:
        return silver.uf_resultado(self.inputs["b_uf"], stamp(PROCESSED_AT))

    @cached_property
    def targets(self) -> DataFrame:
        return silver.meta_municipio(self.inputs["b_meta_municipio"], stamp(PROCESSED_AT))

    @cached_property
    def state_targets(self) -> DataFrame:
        return silver.meta_uf(self.inputs["b_meta_uf"], stamp(PROCESSED_AT))

    @cached_property
    def national_targets(self) -> DataFrame:
        return silver.meta_brasil(self.inputs["b_meta_brasil"], stamp(PROCESSED_AT))

    @cached_property
    def students(self) -> DataFrame:
        return silver.alunos_tratados(self.inputs["b_students"], stamp(PROCESSED_AT))

    @cached_property
    def checked(self) -> DataFrame:
        return contract.validate(self.inputs["b_messages"], as_of=stamp(AS_OF))

    @cached_property
    def valid_events(self) -> DataFrame:
        return contract.accepted(self.checked, stamp(AS_OF))

    @cached_property
    def events(self) -> DataFrame:
        return silver.eventos_indicador_tratados(self.valid_events)

    @cached_property
    def stored_targets(self) -> DataFrame:
        """The cleaned targets as a written table, for the indicator, whose two branches read them by different keys."""
        path = self.folder("targets")
        loader.replace_table(self.targets, path)
        return tables.read_table(self.spark, path)

    @cached_property
    def indicator(self) -> DataFrame:
        return gold.indicador_municipio(self.results, self.stored_targets, self.dim, self.events, stamp(PROCESSED_AT))

    @cached_property
    def stored_current(self) -> DataFrame:
        """The current status as a written table, for the ranking, which reads its input more than once."""
        path = self.folder("current")
        loader.replace_table(self.current, path)
        return tables.read_table(self.spark, path)

    def colocated(self, *names: str) -> list[DataFrame]:
        """Some of results, targets and events as catalog tables in buckets of their common keys."""
        cleaned = {"municipio_resultado": "results", "meta_municipio": "targets", "eventos_indicador_tratados": "events"}
        wanted = {name: getattr(self, cleaned[name]) for name in names}
        database = f"colocated_{uuid.uuid4().hex[:12]}"
        number = pieces(self.inputs.size(*TABLES), INPUT_BYTES_PER_BUCKET, 8)
        return list(colocated.store_colocated(self.spark, database, self.folder("colocated"), wanted, number, writers=1).values())

    @cached_property
    def current(self) -> DataFrame:
        return gold.situacao_atual_municipio(self.indicator)

    @cached_property
    def series(self) -> DataFrame:
        return gold.evolucao_temporal(self.indicator)

    @cached_property
    def ranked(self) -> DataFrame:
        return gold.ranking_municipios(self.stored_current)

    def sources(self, names: Sequence[str] = TABLES) -> list[dict]:
        return catalog.build_source_list(
            {
                "source_project": "driver",
                "source_dataset": "tables",
                "sources": [{"name": n, "source_table": n, "destination_table": n} for n in names],
            }
        )

    def read(self, source: Mapping) -> DataFrame:
        return self.inputs[source["source_table"]]

    def loader(self, root: str, run_id: str, **options) -> loader.Loader:
        return loader.Loader(self.spark, root, self.read, run_id=run_id, **options)


# --- sources and sinks ---------------------------------------------------------------------


@proof
def io1_catalog_counts(lake: Lake) -> DataFrame:
    return catalog.catalog_counts(lake.sources(), lake.read)


@proof
def io2_snapshot_append(lake: Lake) -> DataFrame:
    root, names = lake.folder("snapshots"), ("customer", "orders")
    for run_id in ("run-1", "run-2"):
        lake.loader(root, run_id).run(lake.sources(names))
    stored = [
        tables.read_table(lake.spark, f"{root}/{n}").groupBy("_source_table", "_ingestion_run_id").count()
        for n in names
    ]
    return stored[0].unionByName(stored[1]).select(
        F.col("_source_table").alias("source_table"),
        F.col("_ingestion_run_id").alias("run_id"),
        F.col("count").alias("n_rows"),
    )


@proof
def io4_sample_hash(lake: Lake) -> DataFrame:
    return loader.sample_by_hash(lake.inputs["orders"], ["o_orderkey"], 500).select("o_orderkey", "o_custkey")


@proof
def io4_sample_once(lake: Lake) -> DataFrame:
    root = lake.folder("sample")
    keys = ["l_orderkey", "l_linenumber"]
    source = {**lake.sources(["lineitem"])[0], "mode": catalog.SAMPLE_ONCE, "sample_rows": 500, "sample_keys": keys}
    _, created = lake.loader(root, "run-1").load(source)
    _, reused = lake.loader(root, "run-2").load(source)
    stored = tables.read_table(lake.spark, f"{root}/lineitem")
    run, actions = F.col("_ingestion_run_id").alias("run_id"), (created, reused)
    return stored.select(*keys, run, *[F.lit(a).alias(n) for n, a in zip(("first_action", "second_action"), actions)])


@proof
def io8_export_roundtrip(lake: Lake) -> DataFrame:
    path = lake.folder("export")
    for _ in range(2):
        tables.export_run(lake.inputs["b_runs"], "run-2001", path)
    stored = lake.spark.read.parquet(path)
    return stored.groupBy("run_id", F.col("ingestion_date").cast("string").alias("day")).agg(
        F.count("*").alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


def _labelled(column: str, **frames: DataFrame) -> DataFrame:
    """Rows of all frames, each with its name in ``column``."""
    parts = [df.withColumn(column, F.lit(name)) for name, df in frames.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@proof
def io9_atomic_replace(lake: Lake) -> DataFrame:
    """What a table shows before, during and after its replacement, and after a replacement that fails."""
    path, orders = lake.folder("replaced"), lake.inputs["orders"]
    last = orders.select(F.max("o_orderkey")).scalar()
    broken = F.when(F.col("o_orderkey") == last, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("o_orderpriority"))
    loader.replace_table(orders.where("o_orderstatus = 'F'"), path)
    before = tables.read_table(lake.spark, path)
    try:
        loader.replace_table(orders.withColumn("o_orderpriority", broken), path)
        raise RuntimeError("the replacement should have failed")
    except PySparkException:
        after_failure = tables.read_table(lake.spark, path)
    staged = tables.stage(orders.where("o_orderstatus <> 'F'"), path, ["o_orderdate"])
    during = tables.read_table(lake.spark, path)
    after = staged.publish()
    shown = _labelled("moment", before=before, after_failure=after_failure, during=during, after=after)
    return shown.groupBy("moment").agg(F.count("*").alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@proof
def io10_partial_load(lake: Lake) -> DataFrame:
    """Audit rows of a load in which one source cannot be read, one has an unknown mode and some are not asked for."""
    sources = lake.sources()
    sources += [{**sources[0], "name": n, "source_table": n, "destination_table": n, "mode": m} for n, m in
                (("no_such_table", catalog.FULL_SNAPSHOT), ("orders_by_hand", "by_hand"))]
    root = lake.folder("partial")
    load = lake.loader(root, "run-1", audit_path=f"{root}/audit")
    only = {"nation", "orders", "events", "no_such_table", "orders_by_hand"}
    load.run(sources, only=only, strict=False)
    stored = tables.read_table(lake.spark, f"{root}/audit")
    return stored.select("destination_table", "status", "rows_processed", F.col("error_message").isNotNull().alias("has_error"))


@proof
def io11_run_audit(lake: Lake) -> DataFrame:
    audit = lake.loader(lake.folder("audited"), "run-1").run(lake.sources())
    return audit.select("destination_table", "status", "rows_processed")


@proof
def io12_preflight(lake: Lake) -> DataFrame:
    return catalog.preflight(lake.sources(), lake.read)


@proof
def io15_partition_pruned_scan(lake: Lake) -> DataFrame:
    path = lake.folder("clustered")
    by_day = lake.inputs["events"].withColumn("day", F.to_date("ts"))
    tables.write_clustered(by_day, path, ["event_type", "user_id"], ["day"])
    week = tables.read_table(lake.spark, path).where(F.col("day").between("2024-01-08", "2024-01-14"))
    return week.groupBy("event_type").agg(F.count("*").alias("n_rows"), F.round(F.sum("value"), 2).alias("total"))


@proof
def io15_point_lookup(lake: Lake) -> DataFrame:
    """Lines of the dearest order, looked up by its key in a table with a Bloom filter on that key, sorted by another."""
    path, orders = lake.folder("looked-up"), lake.inputs["orders"]
    tables.stage(lake.inputs["lineitem"], path, ["l_shipdate"], look_up=["l_orderkey"]).publish()
    dearest = orders.select(F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey"))).scalar()
    lines = tables.read_table(lake.spark, path).where(F.col("l_orderkey") == dearest)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@proof
def io15_interleaved_scan(lake: Lake) -> DataFrame:
    """Orders of the busiest customer and orders of the first week, from one table interleaved by customer and day."""
    path, orders = lake.folder("interleaved"), lake.inputs["orders"]
    tables.stage(orders, path, ["o_custkey", "o_orderdate"], interleave=True).publish()
    stored = tables.read_table(lake.spark, path)
    counts = orders.groupBy("o_custkey").count()
    busiest = counts.select(F.max_by("o_custkey", F.struct("count", -F.col("o_custkey")))).scalar()
    first = orders.select(F.min("o_orderdate")).scalar()
    parts = _labelled(
        "part",
        customer=stored.where(F.col("o_custkey") == busiest),
        week=stored.where(F.col("o_orderdate") < first + F.expr("interval 7 days")),
    )
    return parts.groupBy("part", "o_orderpriority").agg(F.count("*").alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@proof
def io14_checked_publish(lake: Lake) -> DataFrame:
    """Rows served after a good version, after one that breaks its rules, and after that one without strictness."""
    events, root = lake.inputs["events"], lake.folder("checked")
    model = lakehouse.Model("events", lambda t: t["events"], ("event_type", "user_id"))
    rules = [quality.row_condition("events", "value", F.col("value").between(0, 100)), quality.unique_key("events", ["event_id"])]

    def refresh(rows: DataFrame, strict: bool) -> DataFrame:
        return lakehouse.refresh_layer(lake.spark, [model], {"events": rows}, f"{root}/lake", rules, f"{root}/checks", strict)["events"]

    good = refresh(events.where("value between 0 and 100"), True)
    try:
        refresh(events, True)
        raise RuntimeError("the rules should have stopped this version")
    except quality.QualityFailure:
        after_violation = tables.read_table(lake.spark, f"{root}/lake/events")
    reported = refresh(events, False)
    seen = _labelled("step", good=good, after_violation=after_violation, reported=reported)
    seen = seen.groupBy(F.concat(F.lit("served_"), "step").alias("name")).agg(F.count("*").alias("value"))
    checks = tables.read_table(lake.spark, f"{root}/checks")
    return seen.unionByName(checks.groupBy(F.col("check_name").alias("name")).agg(F.max("violations").alias("value")))


@proof
def io17_compacted_stream(lake: Lake) -> DataFrame:
    """Events and rejects of a stream whose closed micro-batches were compacted while it ran on, against the batch result."""
    root, messages = lake.folder("compacted"), lake.inputs["b_messages"].select(F.col("value").cast("binary"), "message_id")
    part = F.pmod(F.xxhash64("message_id"), F.lit(4))
    # three micro-batches a drain, of as many files as keep one small
    files = pieces(lake.inputs.size("events"), 3 * EVENT_BYTES_PER_FILE)

    def drain() -> None:
        stream = sinks.file_messages(lake.spark, f"{root}/messages", files)
        sinks.start(stream, f"{root}/out", f"{root}/checkpoint", as_of=stamp(AS_OF), drain=True).awaitTermination()

    for chosen in (part < 3, part == 3):
        messages.where(chosen).repartition(3 * files).write.mode("append").parquet(f"{root}/messages")
        drain()
        for name in (sinks.VALID, sinks.REJECTED):
            sinks.write_compacted(lake.spark, f"{root}/out", sinks.closed_batches(lake.spark, f"{root}/out", name), name)  # not committed
            sinks.compact(lake.spark, f"{root}/out", name, f"{root}/checkpoint")
            sinks.remove_covered(lake.spark, f"{root}/out", name, grace_seconds=0)
    return _against_batch(lake, f"{root}/out")


# --- projections ---------------------------------------------------------------------------


@proof
def p1_safe_cast(lake: Lake) -> DataFrame:
    raw = lake.inputs["events"].select(
        "event_type",
        "value",
        F.col("value").cast("string").alias("value_text"),
        F.regexp_extract("props", "([0-9]+)", 1).alias("k_text"),
    )
    typed = raw.select(
        "event_type",
        normalise.safe_long(raw, "event_type").alias("word_long"),
        normalise.safe_long(raw, "k_text").alias("k_long"),
        normalise.safe_long(raw, "value_text").alias("text_long"),
        normalise.safe_long(raw, "value").alias("value_long"),
        normalise.safe_double(raw, "value_text").alias("text_double"),
    )
    return typed.groupBy("event_type").agg(
        F.count("word_long").alias("n_word"),
        F.sum("k_long").alias("sum_k"),
        F.count("text_long").alias("n_text_long"),
        F.sum("value_long").alias("sum_value_long"),
        F.round(F.sum("text_double"), 2).alias("sum_double"),
    )


@proof
def p2_code_lpad(lake: Lake) -> DataFrame:
    orders = lake.inputs["orders"].withColumn("long_text", F.concat(F.lit("9"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0")))
    return orders.select(
        "o_orderkey",
        normalise.code(orders, "o_orderkey").alias("padded"),
        normalise.code(orders, "long_text").alias("cut"),
    )


@proof
def p3_label_normalise(lake: Lake) -> DataFrame:
    raw = lake.inputs["b_students"]
    labels = [normalise.lower_label(raw, c).alias(c) for c in ("serie", "rede", "presenca")]
    clean = raw.select(*labels, normalise.upper_label(raw, "alfabetizado").alias("alfabetizado"))
    return clean.groupBy(*clean.columns).agg(F.count("*").alias("n_rows"))


@proof
def p4_tristate_flag(lake: Lake) -> DataFrame:
    raw = lake.inputs["b_students"]
    token = raw.select("alfabetizado", normalise.lower_label(raw, "alfabetizado").alias("token"))
    flagged = token.withColumn("flag", normalise.tristate_flag(F.col("token")))
    return flagged.groupBy("token", "flag").agg(F.count("*").alias("n_rows"))


@proof
def p10_gap_status(lake: Lake) -> DataFrame:
    rows = gold.batch_branch(lake.results, lake.targets, lake.dim)
    rate, target = F.col("taxa_alfabetizacao"), F.col("meta_alfabetizacao")
    return rows.select(
        "ano_resultado",
        "ano_meta",
        "id_municipio",
        "serie",
        "rede",
        measures.gap(rate, target).alias("gap"),
        measures.target_status(rate, target).alias("status"),
    )


@proof
def p12_status_unguarded(lake: Lake) -> DataFrame:
    summary = gold.resumo_brasil(lake.national_targets, stamp(PROCESSED_AT)).drop("_gold_generated_at")
    numbers = ("taxa_alfabetizacao", "meta_alfabetizacao", "gap_meta_pontos_percentuais", "percentual_participacao")
    return summary.select("ano_resultado", "ano_meta", "rede", *numbers, "status_meta")


@proof
def p15_safe_ratio(lake: Lake) -> DataFrame:
    low, negative = F.count_if(F.col("c_acctbal") < -990), F.count_if(F.col("c_acctbal") < -950)
    share = measures.weighted_share(F.when(F.col("c_acctbal") < -950, F.col("c_acctbal") < -990), F.lit(2.0))
    return lake.inputs["customer"].groupBy("c_nationkey", "c_mktsegment").agg(
        measures.safe_percent(low, negative).alias("divided"), share.alias("by_nullif")
    )


# --- filters -------------------------------------------------------------------------------


@proof
def f1_latest_run(lake: Lake) -> DataFrame:
    return picks.latest_run(lake.inputs["b_runs"]).select("o_orderkey", F.col("_ingestion_run_id").alias("run_id"))


def _loaded_by_year(lake: Lake, folder: str) -> tables.Snapshots:
    """Orders loaded as one run a year, not in the order of years."""
    path, orders = lake.folder(folder), lake.inputs["orders"]
    years = sorted((r[0] for r in orders.select(F.year("o_orderdate")).distinct().collect()), key=lambda y: (y % 3, y))
    for year in years:
        rows = orders.where(F.year("o_orderdate") == year)
        loader.append_run(rows, path, f"run-{year}", "driver.tables.orders", datetime(year, 1, 1, tzinfo=timezone.utc))
    return tables.Snapshots(lake.spark, path)


@proof
def f1_latest_run_marked(lake: Lake) -> DataFrame:
    """The newest run as the marks of the runs tell it."""
    newest = picks.latest_run(_loaded_by_year(lake, "marked"))
    return newest.select("o_orderkey", F.col("_ingestion_run_id").alias("run_id"))


@proof
def f1_run_marks(lake: Lake) -> DataFrame:
    return _loaded_by_year(lake, "marks").runs().select("run_id", "day", "rows")


@proof
def f2_not_null(lake: Lake) -> DataFrame:
    rows = lake.current.where(F.col("taxa_alfabetizacao").isNotNull())
    return rows.groupBy(F.col("meta_alfabetizacao").isNull().alias("without_target")).agg(F.count("*").alias("n_rows"))


@proof
def f5_code_format(lake: Lake) -> DataFrame:
    codes = contract.typed(contract.parse(lake.inputs["b_messages"])).where("_id_municipio is not null")
    bad = codes.where(~normalise.is_code(F.col("_id_municipio")))
    return bad.select("message_id", F.col("_id_municipio").alias("id_municipio"))


@proof
def q6_not_future(lake: Lake) -> DataFrame:
    late = quality.in_future(stamp("2024-01-20 00:00:00"))
    return lake.events.where(late).select("id_evento", shown("data_evento"))


# --- joins ---------------------------------------------------------------------------------


@proof
def j1_result_targets_left(lake: Lake) -> DataFrame:
    return _target_sums(lake.results, lake.targets)


@proof
def j1_colocated_targets(lake: Lake) -> DataFrame:
    """Results and targets joined bucket by bucket."""
    return _target_sums(*lake.colocated("municipio_resultado", "meta_municipio"))


def _target_sums(results: DataFrame, targets: DataFrame) -> DataFrame:
    keys = {"ano": "ano_resultado", "id_municipio": "id_municipio", "rede": "rede"}
    rows = joins.with_targets(results, targets, keys, ("ano_meta", "meta_alfabetizacao"))
    return rows.groupBy("ano_meta").agg(
        F.count("*").alias("n_rows"),
        F.round(F.sum("meta_alfabetizacao"), 4).alias("sum_target"),
        F.round(F.sum("taxa_alfabetizacao"), 4).alias("sum_rate"),
    )


@proof
def j2_dim_enrich(lake: Lake) -> DataFrame:
    rows = joins.with_territory(lake.results, lake.dim, gold.TERRITORY)
    return rows.groupBy("sigla_uf", "nome_uf", "regiao").agg(
        F.count("*").alias("n_rows"), F.count_distinct("nome_municipio").alias("n_names")
    )


@proof
def j3_event_target_fallback(lake: Lake) -> DataFrame:
    numbers = ("taxa_alfabetizacao", "meta_alfabetizacao", "percentual_participacao")
    rows = gold.stream_branch(lake.events, lake.targets, lake.dim)
    return rows.select("ano_meta", "id_municipio", "serie", "rede", "sigla_uf", "nivel_alfabetizacao", *numbers)


@proof
def j5_uf_mismatch(lake: Lake) -> DataFrame:
    return quality.state_mismatches(lake.events, lake.dim)


@proof
def j6_orphans_anti(lake: Lake) -> DataFrame:
    parts = [
        joins.orphans(df, lake.dim).groupBy("id_municipio").agg(F.count("*").alias("n_rows")).withColumn("kind", F.lit(kind))
        for kind, df in (("result", lake.results), ("target", lake.targets))
    ]
    return parts[0].unionByName(parts[1]).select("kind", "id_municipio", "n_rows")


@proof
def j8_nearest_target(lake: Lake) -> DataFrame:
    return _nearest(lake, lake.results, lake.targets)


@proof
def j8_colocated_nearest_target(lake: Lake) -> DataFrame:
    """Join and pick bucket by bucket; the directory alone is shuffled or broadcast."""
    return _nearest(lake, *lake.colocated("municipio_resultado", "meta_municipio"))


def _nearest(lake: Lake, results: DataFrame, targets: DataFrame) -> DataFrame:
    rows = gold.batch_branch(results, targets, lake.dim)
    order = [measures.target_distance(F.col("ano_meta"), F.col("ano_resultado")), F.col("ano_meta").asc()]
    nearest = picks.first_per_key(rows, ["ano_resultado", "id_municipio", "serie", "rede"], order)
    return nearest.select("ano_resultado", "id_municipio", "serie", "rede", "ano_meta", "meta_alfabetizacao")


# --- aggregates ----------------------------------------------------------------------------


@proof
def a1_count_group(lake: Lake) -> DataFrame:
    return lake.students.groupBy(*gold.FEATURE_KEYS).agg(F.count("*").alias("quantidade_alunos"))


def _features(lake: Lake, *names: str) -> DataFrame:
    return gold.student_features(lake.students).select(*gold.FEATURE_KEYS, *names)


@proof
def a2_countif(lake: Lake) -> DataFrame:
    flag = F.col("alfabetizado_flag")
    return lake.students.groupBy(*gold.FEATURE_KEYS).agg(
        F.count_if(F.col("presenca").isin(*measures.PRESENT_TOKENS)).alias("presentes"),
        F.count_if(flag).alias("alfabetizados"),
        F.count_if(flag.isNotNull()).alias("conhecidos"),
    )


@proof
def a3_avg_stddev(lake: Lake) -> DataFrame:
    spread = F.round("proficiencia_desvio_padrao", 4).alias("proficiencia_desvio_padrao")
    numbers = _features(lake, "proficiencia_media", "proficiencia_desvio_padrao")
    return numbers.select(*gold.FEATURE_KEYS, "proficiencia_media", spread)


@proof
def a5_weighted_share(lake: Lake) -> DataFrame:
    return _features(lake, "percentual_alfabetizados_ponderado")


@proof
def a6_min_max(lake: Lake) -> DataFrame:
    return lake.results.groupBy(*gold.FEATURE_KEYS).agg(
        F.min("taxa_alfabetizacao").alias("menor_taxa"),
        F.max("taxa_alfabetizacao").alias("maior_taxa"),
        F.max("media_portugues").alias("maior_media"),
    )


@proof
def a7_conditional_extrema(lake: Lake) -> DataFrame:
    rows = gold.target_features(lake.targets, final=2030, first=2027)
    return rows.select(*gold.FEATURE_KEYS, "meta_2030", "primeira_meta", "nivel_alfabetizacao")


@proof
def a8_arg_max(lake: Lake) -> DataFrame:
    best = measures.arg_max(F.col("serie"), F.col("taxa_alfabetizacao"))
    return lake.results.groupBy(*gold.FEATURE_KEYS).agg(best.alias("serie_referencia"))


@proof
def a9_count_distinct(lake: Lake) -> DataFrame:
    """Both counts read one written table of the series' places: the series itself is found once."""
    path, places = lake.folder("places"), F.count_distinct("id_municipio").alias("municipios")
    loader.replace_table(lake.series.select("ano", "sigla_uf", "id_municipio").distinct(), path)
    stored = tables.read_table(lake.spark, path)
    by_state = stored.groupBy("ano", "sigla_uf").agg(places)
    overall = stored.agg(places).select(
        F.lit(0).cast("bigint").alias("ano"), F.lit("TODAS").alias("sigla_uf"), "municipios"
    )
    return by_state.unionByName(overall)


# --- windows, sorts, unions ----------------------------------------------------------------


@proof
def w1_keep_latest(lake: Lake) -> DataFrame:
    kept = picks.keep_latest(lake.inputs["lineitem"], ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return kept.withColumn("l_shipdate", F.col("l_shipdate").cast("date").cast("string"))


_STATUS = (
    "ano_resultado", "ano_meta", "id_municipio", "nome_municipio", "sigla_uf", "serie", "rede",
    "status_meta", "origem_dado",
)


@proof
def w2_current_status(lake: Lake) -> DataFrame:
    return lake.current.select(*_STATUS, "taxa_alfabetizacao", "meta_alfabetizacao")


@proof
def w3_series_priority(lake: Lake) -> DataFrame:
    return lake.series.withColumn("atualizado_em", shown("atualizado_em"))


@proof
def w4_latest_event(lake: Lake) -> DataFrame:
    return _newest_events(lake.events)


@proof
def w4_colocated_latest_event(lake: Lake) -> DataFrame:
    """The newest event of each key, picked bucket by bucket."""
    return _newest_events(*lake.colocated("eventos_indicador_tratados"))


def _newest_events(events: DataFrame) -> DataFrame:
    rows = gold.latest_event(events)
    return rows.select("ano", "id_municipio", "serie", "rede", "id_evento", shown("data_evento"), "taxa_alfabetizacao")


@proof
def w5_dense_rank_two_level(lake: Lake) -> DataFrame:
    return lake.ranked.select("id_municipio", "sigla_uf", "serie", "rede", "taxa_alfabetizacao", "ranking_brasil", "ranking_uf")


@proof
def io14_catalog_ranking(lake: Lake) -> DataFrame:
    """The ranking view by its name in the session catalog, after the table below it was replaced."""
    root, database = lake.folder("served"), f"lake_{uuid.uuid4().hex[:12]}"
    path = f"{root}/gold/indicador_municipio"
    tables.stage(lake.indicator.limit(0), path).publish()
    served.serve(lake.spark, database, root)
    tables.stage(lake.indicator, path, ["ano_meta", "sigla_uf", "id_municipio", "rede"]).publish()
    served.serve(lake.spark, database, root)
    return lake.spark.sql(
        "SELECT id_municipio, sigla_uf, serie, rede, taxa_alfabetizacao, ranking_brasil, ranking_uf "
        f"FROM {database}.ranking_municipios"
    )


@proof
def w6_dense_rank_orders(lake: Lake) -> DataFrame:
    """The same ranking on a table whose groups hold very many distinct values."""
    prices = lake.inputs["orders"].select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return ranking.two_level_dense_rank(
        prices, "o_totalprice", ["o_orderstatus"], ["o_orderpriority"], "rank_status", "rank_priority"
    )


@proof
def o3_top10(lake: Lake) -> DataFrame:
    top = dashboards.top_ranked(lake.ranked)
    return top.select("ranking_brasil", "ranking_uf", "id_municipio", "nome_municipio", "sigla_uf", "serie", "rede", "taxa_alfabetizacao")


@proof
def u1_union_typed_nulls(lake: Lake) -> DataFrame:
    shares = [F.count(c).alias(f"n_{c[-1]}") for c in silver.LEVEL_SHARES]
    return lake.indicator.groupBy("origem_dado").agg(
        F.count("*").alias("n_rows"),
        F.count("media_portugues").alias("n_media"),
        F.round(F.sum("meta_alfabetizacao"), 4).alias("sum_target"),
        *shares,
    )


@proof
def u2_unpivot_targets(lake: Lake) -> DataFrame:
    def part(kind: str, df: DataFrame, place: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), place.alias("place"), "ano_resultado", "ano_meta", "rede",
                         "meta_alfabetizacao", "taxa_alfabetizacao_base", "percentual_participacao")

    return (
        part("municipio", lake.targets, F.col("id_municipio"))
        .unionByName(part("uf", lake.state_targets, F.col("sigla_uf")))
        .unionByName(part("brasil", lake.national_targets, F.lit("BR")))
    )


# --- events --------------------------------------------------------------------------------


@proof
def st1_parse_events(lake: Lake) -> DataFrame:
    parsed = contract.typed(contract.parse(lake.inputs["b_messages"]))
    return parsed.select("message_id", F.col("_is_object").alias("is_object"))


@proof
def st2_rule_violations(lake: Lake) -> DataFrame:
    broken = lake.checked.select(F.explode("_errors").alias("rule"))
    return broken.groupBy("rule").agg(F.count("*").alias("violations"))


@proof
def st3_route_counts(lake: Lake) -> DataFrame:
    valid, bad = contract.accepted(lake.checked), contract.rejected(lake.checked)
    total = lake.inputs["b_messages"].agg(F.count("*").alias("n_rows")).withColumn("route", F.lit("input"))
    for route, df in (("valid", valid), ("rejected", bad)):
        total = total.unionByName(df.agg(F.count("*").alias("n_rows")).withColumn("route", F.lit(route)))
    return total.select("route", "n_rows")


@proof
def st4_valid_rows(lake: Lake) -> DataFrame:
    numbers = ("taxa_alfabetizacao", "meta_alfabetizacao")
    return lake.valid_events.select(
        "id_evento", "id_municipio", "sigla_uf", "ano", "rede", "serie", "tipo_evento", "fonte",
        "pubsub_message_id", shown("data_evento"), *numbers,
    )


@proof
def st5_dead_letter(lake: Lake) -> DataFrame:
    return contract.rejected(lake.checked).select("payload", "error_message", "pubsub_message_id")


@proof
def st6_stream_equals_batch(lake: Lake) -> DataFrame:
    root = lake.folder("stream")
    lake.inputs["b_messages"].select(F.col("value").cast("binary"), "message_id").write.parquet(f"{root}/messages")
    stream = sinks.file_messages(lake.spark, f"{root}/messages")
    sinks.start(stream, f"{root}/out", f"{root}/checkpoint", as_of=stamp(AS_OF), drain=True).awaitTermination()
    return _against_batch(lake, f"{root}/out")


def _against_batch(lake: Lake, root: str) -> DataFrame:
    """Rows of the two event tables, those the batch result has besides, and those it lacks."""
    batch = {sinks.VALID: contract.accepted(lake.checked), sinks.REJECTED: contract.rejected(lake.checked)}
    parts = []
    for name, expected in batch.items():
        stored = sinks.read_events(lake.spark, root, name).drop("data_processamento")
        parts.append(_bag_difference(stored, expected.drop("data_processamento")).select(F.lit(name).alias("table"), "measure", "value"))
    return parts[0].union(parts[1])


def _bag_difference(stored: DataFrame, expected: DataFrame) -> DataFrame:
    """``measure, value``: rows stored, rows missing and rows in surplus, counted by one pass over either side.

    The counts are those of ``expected.exceptAll(stored)`` and ``stored.exceptAll(expected)``, which would each
    compute and shuffle both sides again.
    """
    sides = {"_stored": stored, "_expected": expected}
    signed = [df.withColumns({n: F.lit(int(n == side)) for n in sides}) for side, df in sides.items()]
    counted = signed[0].unionByName(signed[1]).groupBy(*stored.columns).agg(*[F.sum(n).alias(n) for n in sides])
    have, want = F.col("_stored"), F.col("_expected")
    measures = {"stored": have, "missing": F.greatest(want - have, F.lit(0)), "surplus": F.greatest(have - want, F.lit(0))}
    sums = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in measures.items()])
    return sums.unpivot([], list(measures), "measure", "value")


@proof
def st7_event_dedupe(lake: Lake) -> DataFrame:
    again = lake.valid_events.withColumns(
        {
            "data_processamento": F.col("data_processamento") + F.expr("interval 1 day"),
            "fonte": F.lit("REENVIO"),
            "rede": F.upper("rede"),
        }
    )
    kept = silver.eventos_indicador_tratados(lake.valid_events.unionByName(again))
    return kept.select(
        "id_evento", "id_municipio", "sigla_uf", "ano", "rede", "serie", "fonte",
        "taxa_alfabetizacao", shown("data_processamento"),
    )


# --- quality -------------------------------------------------------------------------------


@proof
def q1_non_null(lake: Lake) -> DataFrame:
    rules = quality.not_null("dim", ("id_municipio", "nome_municipio", "sigla_uf"))
    rules += quality.not_null("results", ("ano", "id_municipio", "serie", "rede", "taxa_alfabetizacao"))
    rules += quality.not_null("indicator", ("id_municipio", "sigla_uf", "rede", "ano_meta"))
    found = {"dim": lake.dim, "results": lake.results, "indicator": lake.indicator}
    return quality.violation_counts(found, rules)


@proof
def q2_unique_key(lake: Lake) -> DataFrame:
    return quality.duplicate_keys(lake.inputs["lineitem"], ["l_orderkey", "l_linenumber"])


@proof
def q3_row_conditions(lake: Lake) -> DataFrame:
    value = F.col("value")
    rules = [
        quality.row_condition("events", "value", value.between(0, 100)),
        quality.row_condition("results", "taxa", F.col("taxa_alfabetizacao").between(10, 90)),
        quality.row_condition("results", "code", normalise.is_code(F.col("id_municipio"))),
    ]
    return quality.violation_counts({"events": lake.inputs["events"], "results": lake.results}, rules)


@proof
def q9_check_report(lake: Lake) -> DataFrame:
    found = {
        "municipio_resultado": lake.results,
        "eventos_indicador_tratados": lake.events,
        "meta_municipio": lake.targets,
        "dim_municipio": lake.dim,
    }
    report = quality.run_checks(lake.spark, found, quality.post_run_checks(), strict=False)
    return report.select("check_name", "status", "violations", "max_violations")


# --- datasets ------------------------------------------------------------------------------


@proof
def m1_dim(lake: Lake) -> DataFrame:
    return lake.dim.drop("_processed_at")


def _result_rows(df: DataFrame, place: str) -> DataFrame:
    numbers = ("taxa_alfabetizacao", "media_portugues", *silver.LEVEL_SHARES)
    return df.select("ano", place, "serie", "rede", *numbers)


@proof
def m2_result(lake: Lake) -> DataFrame:
    return _result_rows(lake.results, "id_municipio")


@proof
def m3_state_result(lake: Lake) -> DataFrame:
    return _result_rows(lake.state_results, "sigla_uf")


@proof
def m7_students(lake: Lake) -> DataFrame:
    return lake.students.drop("_ingested_at", "_ingestion_run_id", "_processed_at")


@proof
def g_indicador_municipio(lake: Lake) -> DataFrame:
    numbers = (
        "taxa_alfabetizacao", "media_portugues", "meta_alfabetizacao", "percentual_participacao",
        *silver.LEVEL_SHARES, "gap_meta_pontos_percentuais",
    )
    return lake.indicator.select(
        *_STATUS, "nome_uf", "regiao", "nivel_alfabetizacao", shown("atualizado_em"), *numbers
    )


def _stored_runs(lake: Lake, view: str, path: str, run_ids: Sequence[str]) -> tables.Snapshots:
    """The rows of some runs of a source view as the loader stores them, marked as committed.

    A committed run lies there for good and is not stored again.
    """
    stored = {run.run_id for run in commits.runs(lake.spark, path)}
    run_ids = [run_id for run_id in run_ids if run_id not in stored]
    if not run_ids:
        return tables.Snapshots(lake.spark, path)
    rows = lake.inputs[view].where(F.col("_ingestion_run_id").isin(*run_ids))
    # the days of the few runs are known before the rows are written; a window over a run would put its rows in one task
    known = rows.groupBy("_ingestion_run_id").agg(
        F.to_date(F.min("_ingested_at")).alias("ingestion_date"),
        F.date_format(F.max("_ingested_at"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("stamp"),
        F.count("*").alias("n"),
    ).collect()
    day = F.lit(None).cast("date")
    for r in known:
        day = F.when(F.col("_ingestion_run_id") == r["_ingestion_run_id"], F.lit(r["ingestion_date"])).otherwise(day)
    dated = rows.withColumn("ingestion_date", day)
    dated.write.mode("overwrite").partitionBy("ingestion_date", "_ingestion_run_id").parquet(path)
    for run_id, day, moment, n in known:
        commits.add_run(lake.spark, path, commits.Run(moment, run_id, str(day), n))
    return tables.Snapshots(lake.spark, path)


@proof
def m9_refreshed_indicator(lake: Lake) -> DataFrame:
    """The municipal indicator after three refreshes by touched keys: a new run, late events and repeated deliveries."""
    root, views = lake.folder("refreshed"), {"municipio": "b_municipio", "meta_alfabetizacao_municipio": "b_meta_municipio",
                                             "diretorio_municipio": "b_directory"}
    messages = lake.inputs["b_messages"].select(F.col("value").cast("binary"), "message_id")
    part = F.pmod(F.xxhash64("message_id"), F.lit(12))
    for chosen, run_ids in ((part < 10, ["run-1"]), ((part >= 9) & (part < 11), ["run-1", "run-2"]), (part == 11, ["run-1", "run-2"])):
        bronze = {name: _stored_runs(lake, view, f"{root}/bronze/{name}", run_ids) for name, view in views.items()}
        messages.where(chosen).write.mode("append").parquet(f"{root}/messages")
        stream = sinks.file_messages(lake.spark, f"{root}/messages")
        sinks.start(stream, f"{root}/stream", f"{root}/checkpoint", as_of=stamp(AS_OF), drain=True).awaitTermination()
        rows = refresh.refresh_indicator(lake.spark, bronze, f"{root}/stream", root, f"{root}/checkpoint", stamp(PROCESSED_AT), buckets=2)
    numbers = ("taxa_alfabetizacao", "media_portugues", "meta_alfabetizacao", "percentual_participacao", "gap_meta_pontos_percentuais")
    return rows.select(*_STATUS, "nome_uf", "regiao", "nivel_alfabetizacao", *numbers, *silver.LEVEL_SHARES)


@proof
def g_indicador_uf(lake: Lake) -> DataFrame:
    numbers = (
        "taxa_alfabetizacao", "media_portugues", "meta_alfabetizacao", "percentual_participacao",
        "gap_meta_pontos_percentuais", *silver.LEVEL_SHARES,
    )
    rows = gold.indicador_uf(lake.state_results, lake.state_targets, stamp(PROCESSED_AT))
    return rows.select("ano_resultado", "ano_meta", "sigla_uf", "serie", "rede", "status_meta", *numbers)


@proof
def g_features_ml(lake: Lake) -> DataFrame:
    rows = gold.features_ml(lake.students, lake.results, lake.targets, lake.dim, stamp(PROCESSED_AT))
    return rows.drop("_gold_generated_at").withColumn(
        "proficiencia_desvio_padrao", F.round("proficiencia_desvio_padrao", 4)
    )


@proof
def d1_kpis(lake: Lake) -> DataFrame:
    return dashboards.kpis(lake.current)


@proof
def d2_map(lake: Lake) -> DataFrame:
    return dashboards.municipal_map(lake.current)


@proof
def d3_ranking(lake: Lake) -> DataFrame:
    return dashboards.ranking_table(lake.ranked)


@proof
def d4_evolution(lake: Lake) -> DataFrame:
    return dashboards.evolution(lake.series).withColumn("taxa_media", F.round("taxa_media", 9))


@proof
def d5_event_count(lake: Lake) -> DataFrame:
    return dashboards.valid_event_count(lake.valid_events)


def _refresh(lake: Lake, root: str, audit_path: str | None = None) -> dict[str, DataFrame]:
    """All tables of a full run over the source tables."""
    names = {
        "diretorio_municipio": "b_directory",
        "municipio": "b_municipio",
        "uf": "b_uf",
        "meta_alfabetizacao_brasil": "b_meta_brasil",
        "meta_alfabetizacao_uf": "b_meta_uf",
        "meta_alfabetizacao_municipio": "b_meta_municipio",
        "alunos_amostra": "b_students",
    }
    sources = {name: lake.inputs[view] for name, view in names.items()}
    sources["eventos_indicador"] = lake.valid_events
    return lakehouse.build_lakehouse(lake.spark, sources, root, stamp(AS_OF), audit_path, strict=False)


@proof
def q_assertions_report(lake: Lake) -> DataFrame:
    """Outcome of every assertion and check of a full run, as its audit table keeps them."""
    root = lake.folder("asserted")
    _refresh(lake, f"{root}/lake", f"{root}/checks")
    report = tables.read_table(lake.spark, f"{root}/checks")
    return report.select("check_name", "status", "violations", "max_violations")


@proof
def full_refresh_counts(lake: Lake) -> DataFrame:
    """Every stored table and view of a full run, with its rows."""
    built = _refresh(lake, lake.folder("lake"))
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("name"), "n_rows") for n, df in built.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
