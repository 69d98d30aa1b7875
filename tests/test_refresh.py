"""A refresh by touched keys against a full run after every step."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from indicator_lake.operators.reshape import TARGET_YEARS
from indicator_lake.plans import gold, refresh, silver
from indicator_lake.sources import commits, loader, tables
from indicator_lake.sources.cells import read_cells, replace_cells
from indicator_lake.streaming import sinks

PLACES = [f"{1000000 + i}" for i in range(12)]
START = datetime(2024, 3, 1, 12, tzinfo=timezone.utc)
STAMPS = ("atualizado_em", "_gold_generated_at")


def runs_of(rng, number):
    """Rows of one run of the three sources; later runs change some of them."""
    def rate():
        return str(rng.randint(0, 100))

    fixed = random.Random(1)
    results = [(str(y), p, "2 ano", n, str(fixed.randint(0, 100))) for y in (2023, 2024) for p in PLACES for n in ("municipal", "estadual")]
    results = [(*r[:4], rate()) if number and rng.random() < 0.1 else r for r in results]
    targets = [(str(y), p, "municipal", *[str(fixed.randint(0, 100)) for _ in TARGET_YEARS]) for y in (2023, 2024) for p in PLACES[:9]]
    targets = [(*t[:3], *[rate() for _ in TARGET_YEARS]) if number == 2 and rng.random() < 0.2 else t for t in targets]
    places = [(p, f"Nome {p}{'!' if number == 2 and p == PLACES[3] else ''}", "SP") for p in PLACES[: 11 if number else 12]]
    return results, targets, places


def load(spark, root, number):
    results, targets, places = runs_of(random.Random(100 + number), number)
    levels = [f"proporcao_aluno_nivel_{k}" for k in range(9)]
    frames = {
        "municipio": spark.createDataFrame(results, "ano string, id_municipio string, serie string, rede string, taxa_alfabetizacao string")
        .withColumns({c: F.lit("1") for c in ("media_portugues", *levels)}),
        "meta_alfabetizacao_municipio": spark.createDataFrame(
            targets, "ano string, id_municipio string, rede string, " + ", ".join(f"meta_alfabetizacao_{y} string" for y in TARGET_YEARS)
        ).withColumns({c: F.lit("2") for c in ("taxa_alfabetizacao", "nivel_alfabetizacao", "percentual_participacao")}),
        "diretorio_municipio": spark.createDataFrame(places, "id_municipio string, nome string, sigla_uf string")
        .withColumns({c: F.lit("x") for c in ("nome_uf", "regiao", "id_microrregiao", "id_mesorregiao")}),
    }
    for name, df in frames.items():
        loader.append_run(df, f"{root}/bronze/{name}", f"run-{number}", name, START + timedelta(days=number))
    return {name: tables.Snapshots(spark, f"{root}/bronze/{name}") for name in frames}


def send(spark, root, events):
    rows = []
    for i, place, day, rate in events:
        body = {"id_evento": i, "id_municipio": place, "sigla_uf": "SP", "ano": 2024 + day % 2, "rede": "Municipal", "serie": "2 ANO",
                "taxa_alfabetizacao": rate, "data_evento": f"2024-02-{1 + day:02d}T10:00:00Z"}
        rows.append((bytearray(json.dumps(body).encode()), f"m-{i}-{rate}"))
    spark.createDataFrame(rows, sinks.MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = sinks.file_messages(spark, f"{root}/in")
    sinks.start(stream, f"{root}/stream", f"{root}/checkpoint", as_of=F.lit("2024-06-01").cast("timestamp"), drain=True).awaitTermination()


def plain(df):
    return sorted(map(str, df.drop(*STAMPS).collect()))


def full(spark, root, bronze):
    return gold.indicador_municipio(
        silver.municipio_resultado(bronze["municipio"]),
        silver.meta_municipio(bronze["meta_alfabetizacao_municipio"]),
        silver.dim_municipio(bronze["diretorio_municipio"]),
        silver.eventos_indicador_tratados(sinks.read_events(spark, f"{root}/stream")),
    )


def test_refresh_equals_a_full_run_after_every_step(spark, tmp_path):
    root, rng = str(tmp_path), random.Random(9)

    def refreshed(bronze):
        return refresh.refresh_indicator(spark, bronze, f"{root}/stream", root, f"{root}/checkpoint")

    bronze = load(spark, root, 0)
    send(spark, root, [(f"e{i}", rng.choice(PLACES), rng.randint(0, 20), rng.randint(0, 100)) for i in range(40)])
    assert plain(refreshed(bronze)) == plain(full(spark, root, bronze))
    path = f"{root}/gold/indicador_municipio"
    before = commits.live(spark, path)
    assert plain(refreshed(bronze)) == plain(full(spark, root, bronze)) and commits.live(spark, path) == before  # nothing new
    # late events, one delivered again for another place and day, and a correction
    send(spark, root, [("late", PLACES[0], 0, 7), ("e3", PLACES[5], 19, 50), ("e4", PLACES[1], 2, 51), ("new", "7654321", 5, 5)])
    assert plain(refreshed(bronze)) == plain(full(spark, root, bronze))
    after = commits.live(spark, path)
    assert 0 < len(set(before.folders) & set(after.folders)) < len(before.folders)  # other cells stay where they are
    bronze = load(spark, root, 1)  # some results change, a place leaves the directory
    assert plain(refreshed(bronze)) == plain(full(spark, root, bronze))
    sinks.compact(spark, f"{root}/stream", checkpoint=f"{root}/checkpoint")
    send(spark, root, [("e5", PLACES[7], 3, 99)])
    sinks.compact(spark, f"{root}/stream", checkpoint=f"{root}/checkpoint")
    sinks.remove_covered(spark, f"{root}/stream", grace_seconds=0)
    bronze = load(spark, root, 2)  # targets, a name and an event at once
    assert plain(refreshed(bronze)) == plain(full(spark, root, bronze))
    assert plain(read_cells(spark, f"{root}/silver/eventos_indicador_tratados")) == plain(
        silver.eventos_indicador_tratados(sinks.read_events(spark, f"{root}/stream"))
    )


def test_a_refresh_stopped_between_its_steps_is_made_good(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    bronze = load(spark, root, 0)
    send(spark, root, [(f"e{i}", PLACES[i % 12], i % 20, i) for i in range(30)])

    def refreshed():
        return refresh.refresh_indicator(spark, bronze, f"{root}/stream", root, f"{root}/checkpoint")

    refreshed()
    send(spark, root, [("x", PLACES[2], 4, 77)])
    monkeypatch.setattr(refresh, "_touched", lambda *_: (_ for _ in ()).throw(OSError("driver lost")))
    with pytest.raises(OSError):
        refreshed()
    monkeypatch.undo()
    assert plain(refreshed()) == plain(full(spark, root, bronze))


def test_cells_are_replaced_one_by_one(spark, tmp_path):
    path, day = str(tmp_path / "t"), F.col("day")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, day string")
    replace_cells(rows, path, day)
    replace_cells(spark.createDataFrame([(9, "b"), (8, "c")], "id int, day string"), path, day, {"b", "none"}, {"k": 1})
    assert sorted((r.id, r.day) for r in read_cells(spark, path).collect()) == [(1, "a"), (8, "c"), (9, "b")]
    assert [r.id for r in read_cells(spark, path, {"c"}).collect()] == [8] and commits.live(spark, path).extra == {"k": 1}
    assert read_cells(spark, path, {"z"}).count() == 0 and read_cells(spark, str(tmp_path / "none")) is None
    commits.remove_old(spark, path, 0)
    assert read_cells(spark, path).count() == 3
    assert sorted(p.name for p in (tmp_path / "t").glob("version-*/cell=*")) == ["cell=a", "cell=b", "cell=c"]


def test_cells_changed_meanwhile_are_not_overwritten(spark, tmp_path, monkeypatch):
    path, rows = str(tmp_path / "t"), spark.createDataFrame([(1, "a")], "id int, day string")
    replace_cells(rows, path, F.col("day"))
    make = commits.new_folder

    def overtaken():
        monkeypatch.setattr(commits, "new_folder", make)
        replace_cells(rows, path, F.col("day"), {"a"})
        return make()

    monkeypatch.setattr(commits, "new_folder", overtaken)
    with pytest.raises(commits.CommitConflict):
        replace_cells(rows, path, F.col("day"), {"a"})
