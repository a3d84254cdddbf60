"""Transitions of keys: order, split input, finished keys, timers and expiry."""

import time

from pyspark.sql import functions as F

from contactflow.plans.fixtures import Inputs
from contactflow.streaming import jobs, key_machine

LINES = "rut string, telefone_validado string, email_validado string, sucesso string, erro string, line_no long"
OK, RETRY = ("911111111", "a@b", "1", ""), ("", "", "0", "Read Timeout")


def run(spark, tmp_path, lines, name="one", **options):
    source = jobs.land(spark.createDataFrame([(r, *kind, n) for r, kind, n in lines], LINES).coalesce(1), str(tmp_path / f"in-{name}"))
    key_machine.key_transitions(spark, source, str(tmp_path / f"out-{name}"), str(tmp_path / f"cp-{name}"), **options)
    return key_machine.read_transitions(spark, str(tmp_path / f"out-{name}"))


def moves(df):
    return {r: [(x.n, x.line_no, x.de, x.para) for x in sorted(rows, key=lambda x: x.n)] for r, rows in grouped(df).items()}


def grouped(df):
    out = {}
    for x in df.collect():
        out.setdefault(x.rut, []).append(x)
    return out


def test_each_transition_in_order(spark, tmp_path):
    lines = [("1", RETRY, 3), ("1", OK, 7), ("1", OK, 9), (" 2 ", OK, 1), ("", OK, 2), ("3", RETRY, 4), ("3", RETRY, 5)]
    got = moves(run(spark, tmp_path, lines))
    assert got == {
        "1": [(1, 3, "pendente", "processando"), (2, 3, "processando", "pendente"), (3, 7, "pendente", "processando"), (4, 7, "processando", "telefone_validado")],
        "2": [(1, 1, "pendente", "processando"), (2, 1, "processando", "telefone_validado")],
        "3": [(1, 4, "pendente", "processando"), (2, 4, "processando", "pendente"), (3, 5, "pendente", "processando"), (4, 5, "processando", "pendente")],
    }


def test_split_input_gives_the_same_transitions(spark, sf_dir, tmp_path):
    results = Inputs(spark, sf_dir).macro_result
    cut = results.agg(F.percentile_approx("line_no", 0.4)).first()[0]
    for half in (results.where(F.col("line_no") <= cut), results.where(F.col("line_no") > cut)):
        key_machine.key_transitions(spark, jobs.land(half.coalesce(1), str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    key_machine.key_transitions(spark, jobs.land(results, str(tmp_path / "whole")), str(tmp_path / "out2"), str(tmp_path / "cp2"))
    halves, whole = (sorted(map(str, key_machine.read_transitions(spark, str(tmp_path / o)).collect())) for o in ("out", "out2"))
    assert halves == whole and len(whole) > 20


def test_a_retry_comes_due_and_a_finished_key_does_not(spark, tmp_path):
    run(spark, tmp_path, [("1", RETRY, 1), ("2", RETRY, 2), ("3", OK, 3)], retry_ms=1)
    time.sleep(0.1)
    run(spark, tmp_path, [("2", OK, 4), ("9", OK, 5)], retry_ms=1)
    due = key_machine.read_transitions(spark, str(tmp_path / "out-one"), "prazo")
    found = {r.rut for r in due.collect()}
    assert "1" in found and "3" not in found


def test_a_key_is_forgotten_after_its_expiry(spark, tmp_path):
    run(spark, tmp_path, [("1", OK, 1)], expiry_ms=1)
    time.sleep(0.1)
    got = moves(run(spark, tmp_path, [("1", OK, 2)], expiry_ms=1))
    assert [m[:2] for m in got["1"]] == [(1, 1), (1, 2), (2, 1), (2, 2)]
