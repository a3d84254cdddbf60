"""Plans and files: what is scanned once, pruned, joined by hash, and numbered without a text per client."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from contactflow.functions import geo
from contactflow.operators import contracts, quality, rollups
from contactflow.plans.fixtures import Inputs
from contactflow.plans.queries import day_rollup


def plan(df):
    return df._jdf.queryExecution().toString()


def test_reconcile_reads_each_side_once_and_joins_none_of_it(spark, tmp_path):
    state = spark.createDataFrame([(1, "pendente", None, dt.datetime(2026, 4, 1)), (2, "telefone_validado", 1, dt.datetime(2026, 4, 1)), (3, "x", None, dt.datetime(2026, 4, 2))],
                                  "id long, status string, resposta_id int, data_update timestamp_ntz")
    rolled = spark.createDataFrame([(dt.date(2026, 4, 1), "telefone_validado", "m", 1), (None, None, None, 4)], "dia date, status string, mensagem string, qtd long")
    catalogue = spark.createDataFrame([(1, "m")], "id int, mensagem string")
    for name, df in (("s", state), ("r", rolled)):
        df.write.parquet(f"{tmp_path}/{name}")
    checked = quality.reconcile_rollup(spark.read.parquet(f"{tmp_path}/s"), catalogue, spark.read.parquet(f"{tmp_path}/r"))
    physical = plan(checked).split("== Physical Plan ==")[1]
    assert physical.count("FileScan parquet") == 2 and "NestedLoop" not in physical
    got = {r.verificacao: tuple(r)[1:] for r in checked.collect()}
    assert got == {"total": (1, 1, 5, 1), "status": (2, 1, 5, 1), "mensagem": (2, 1, 5, 1), "dia": (2, 1, 5, 1), "sem_resposta": (3, 3, 2, 1)}
    empty = quality.reconcile_rollup(state.limit(0), catalogue, rolled.limit(0)).collect()
    assert [tuple(r)[1:] for r in empty] == [(0, 0, 0, 0)] * 5


def test_days_and_total_are_one_pass(spark, sf_dir):
    rows = day_rollup(Inputs(spark, sf_dir))
    whole = rollups.summary_with_total(rollups.daily_summary(rows))
    assert rollups.summary_and_total(rows).collect() == whole.collect()
    one = rows.where(F.col("dia") == rows.agg(F.min("dia")).scalar())
    assert rollups.summary_and_total(one).count() == 1 and rollups.summary_and_total(rows.limit(0)).count() == 0


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rollups"))
    i = Inputs(spark, sf_dir)
    rollups.refresh(path, state=i.work_state, catalogue=i.respostas, imports=i.imports, clients=i.clients, now=F.lit("2026-04-07 12:00:00").cast("timestamp_ntz"))
    return i, path


def test_only_chosen_months_are_read(spark, stored):
    i, path = stored
    days = [r.dia for r in day_rollup(i).select("dia").distinct().orderBy("dia").limit(3).collect()]
    for pick in ([str(days[0])], [f"mes:{days[0]:%Y-%m}"], [f"mes:{days[0]:%Y-%m}", str(days[2])]):
        got = rollups.stored_days(spark, path, pick)
        assert re.search(r"PartitionFilters: \[[^\]]*mes#", plan(got)) and re.search(r"PushedFilters: \[[^\]]*dia", plan(got))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rollups.select_days(day_rollup(i), pick).collect()))
    every = day_rollup(i).count()
    assert rollups.stored_days(spark, path, ["mes:2031-01"]).count() == every
    assert rollups.stored_days(spark, path, ["2031-01-01"]).count() == 0
    assert rollups.stored_days(spark, path, []).count() == every
    assert rollups.stored_days(spark, path, ["mes:19"]).count() == rollups.select_days(day_rollup(i), ["mes:19"]).count()


def test_refreshing_a_day_writes_its_month_only(spark, stored):
    from pathlib import Path

    i, path = stored
    before = {p: p.stat().st_mtime_ns for p in Path(path, "day").rglob("*.parquet")}
    day = day_rollup(i).agg(F.min("dia")).first()[0]
    rollups.refresh_days(path, i.work_state, i.respostas, [day], F.lit("2026-04-08 12:00:00").cast("timestamp_ntz"))
    after = {p: p.stat().st_mtime_ns for p in Path(path, "day").rglob("*.parquet")}
    gone = {p.parent.name for p in before if before[p] != after.get(p)}
    assert gone == {f"mes={day.replace(day=1)}"}
    assert sorted(map(str, rollups.read_rollups(spark, path)["day"].collect())) == sorted(map(str, day_rollup(i).select("dia", "status", "mensagem", "qtd").collect()))


def test_communes_meet_their_corrections_by_hash(spark, sf_dir):
    raw = Inputs(spark, sf_dir).raw_clients.select("line_no", "comuna")
    joined = geo.with_clean_commune(raw, "comuna", "comuna")
    assert "BroadcastHashJoin" in plan(joined)
    assert sorted(map(str, joined.collect())) == sorted(map(str, raw.select("line_no", geo.clean_commune(F.col("comuna")).alias("comuna")).collect()))


def test_phone_rows_of_a_hot_client_are_single_numbers(spark):
    hot = spark.range(40_000).selectExpr("1L AS cliente_id", "id", "CAST(900000000 + id % 30000 AS STRING) AS numero")
    rest = spark.createDataFrame([(2, 50_000, "5"), (2, 50_001, None), (2, 50_002, "5"), (2, 50_003, "4"), (3, 50_004, None)], "cliente_id long, id long, numero string")
    phones = hot.unionByName(rest).repartition(8)
    got = contracts.phone_rows(phones)
    assert got.agg(F.max(F.length("numero"))).first()[0] == 9
    mine = got.where("cliente_id = 1").agg(F.count("*"), F.count_distinct("posicao"), F.max("posicao")).first()
    assert tuple(mine) == (30_000, 30_000, 30_000)
    assert [(r.posicao, r.numero) for r in got.where("cliente_id = 2").orderBy("posicao").collect()] == [(1, "5"), (2, "4")]
    text = contracts.phone_text(rest).where("cliente_id = 2").first().telefones
    assert text == "5;4"
    chosen = spark.createDataFrame([(2,), (2,), (9,)], "cliente_id long")
    assert contracts.phones_of(chosen, phones).select("cliente_id").distinct().count() == 1
