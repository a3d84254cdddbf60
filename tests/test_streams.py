"""Streams give the batch answer on the same rows split over files."""

import datetime as dt

from pyspark.sql import functions as F

from contactflow.operators import state
from contactflow.operators.keyed import first_per_key
from contactflow.plans.fixtures import Inputs
from contactflow.streaming import jobs

NOW = "2026-04-07 12:00:00"


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def halves(df, by):
    cut = df.agg(F.percentile_approx(by, 0.5)).first()[0]
    return df.where(F.col(by) <= cut), df.where(F.col(by) > cut)


def test_results_in_two_runs(spark, sf_dir, tmp_path):
    i = Inputs(spark, sf_dir)
    first, second = halves(i.macro_result, "line_no")
    for half in (first, second):
        source = jobs.land(half.coalesce(1), str(tmp_path / "in"))
        jobs.apply_stream(spark, source, i.work_state_u, i.clients, str(tmp_path / "state"), str(tmp_path / "cp"), ["line_no"], NOW)
    batch = state.apply_results(i.work_state_u, i.macro_result, i.clients, ["line_no"], F.lit(NOW).cast("timestamp_ntz"))
    assert rows(jobs.read_state(spark, str(tmp_path / "state"))) == rows(batch)


def test_key_states_in_two_runs(spark, sf_dir, tmp_path):
    results = Inputs(spark, sf_dir).macro_result
    for half in halves(results, "line_no"):
        jobs.key_states(spark, jobs.land(half, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = jobs.read_key_states(spark, str(tmp_path / "out"))
    assert rows(got.drop("tentativas")) == rows(state.resolve_results(results, ["line_no"]))
    assert got.agg(F.sum("tentativas")).first()[0] == results.count()


def test_result_files_with_other_columns_do_not_stop_the_ingest(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()

    def run(name, *lines):
        (folder / name).write_text("\n".join(lines) + "\n" if lines else "", encoding="utf-8")
        jobs.ingest_results(spark, f"{folder}/*_RESULTADO.csv", out, str(tmp_path / "cp"))
        names = ["rut", "telefone_validado", "email_validado", "sucesso"]
        return sorted(tuple(r) for r in jobs.read_ingested(spark, out).select(*names).collect())

    assert run("0_RESULTADO.csv") == []
    first = [("1", "56911111111", "a@x.cl", "1")]
    assert run("a_RESULTADO.csv", "RUT;DV;TELEFONE_VALIDADO;EMAIL_VALIDADO;SUCESSO;ERRO", "1;9;56911111111;a@x.cl;1;") == first
    (folder / "c [1]_RESULTADO.csv").write_text("RUT;SUCESSO\n3;0\n", encoding="utf-8")
    second = [*first, ("2", "56922222222", "b@x.cl", "1"), ("3", "", "", "0")]
    assert run("b_RESULTADO.csv", "\ufeffERRO;SUCESSO;EMAIL_VALIDADO;TELEFONE_VALIDADO;DV;RUT", ";1;b@x.cl;56922222222;7;2") == second
    assert run("d_RESULTADO.csv", "RUT;DV;TELEFONE_VALIDADO;EMAIL_VALIDADO;SUCESSO;ERRO", "4;1;;;0;x") == [*second, ("4", "", "", "0")]


def test_first_wins_in_two_runs(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 30).alias("k"), F.col("id").alias("line_no"))
    for half in halves(df, "line_no"):
        source = jobs.land(half.coalesce(1), str(tmp_path / "in"))
        jobs.first_wins(spark, source, str(tmp_path / "out"), str(tmp_path / "cp"), ["k"], ["line_no"])
    assert rows(spark.read.parquet(f"{tmp_path}/out/*")) == rows(first_per_key(df, ["k"], ["line_no"]))


def test_daily_rollup_drops_only_late_rows(spark, tmp_path):
    def land(*stamps):
        data = [(dt.datetime.fromisoformat(s), "v") for s in stamps]
        return jobs.land(spark.createDataFrame(data, "ts timestamp, kind string").coalesce(1), str(tmp_path / "in"))

    def run(source):
        jobs.daily_rollup(spark, source, str(tmp_path / "out"), str(tmp_path / "cp"), "ts", ["kind"])
        got = jobs.read_rollup(spark, str(tmp_path / "out"), ["kind"])
        return {str(r.dia): r.qtd for r in got.collect()}

    assert run(land("2026-04-01T10:00", "2026-04-05T10:00")) == {"2026-04-01": 1, "2026-04-05": 1}
    # 4 April is within a day of the newest event; 1 April is not.
    assert run(land("2026-04-01T11:00", "2026-04-04T23:00")) == {"2026-04-01": 1, "2026-04-04": 1, "2026-04-05": 1}
