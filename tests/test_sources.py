"""File sources and sinks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from contactflow.functions.fixed_values import EXPORT_FILE
from contactflow.operators import ingest
from contactflow.session import shared_root
from contactflow.sources import files


def test_latin1_file_with_quotes(spark, tmp_path):
    path = tmp_path / "c.txt"
    path.write_bytes('rut;dv;nombre;sexo;direccion;comuna;region;FECHA NAC\n1;K;"PEÑA; ""ANA""";F; X ;ÑUÑOA;DEL MAULE;19800229\n2;;;;\n'.encode("latin-1"))
    rows = files.read_customers(spark, str(path)).orderBy("rut").collect()
    assert rows[0].nombre == 'PEÑA; "ANA"' and rows[0].comuna == "ÑUÑOA" and rows[0].direccion == " X "
    assert rows[1].region == "" and rows[1].fecha_nac == ""


def test_line_numbers_follow_file_order(spark, tmp_path):
    for name, start in [("a", 0), ("b", 500), ("c", 900)]:
        stop = {"a": 500, "b": 900, "c": 1000}[name]
        (tmp_path / f"{name}_RESULTADO.csv").write_text("RUT;SUCESSO\n" + "".join(f"{i};1\n" for i in range(start, stop)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        lines = files.with_line_no(files.read_results(spark, f"{tmp_path}/*_RESULTADO.csv", positions=True))
        got = {int(r.rut): r.line_no for r in lines.collect()}
        assert got == {i: i for i in range(1000)}
        assert ingest.row_limited(lines, 600).agg(F.max(F.col("rut").cast("int"))).first()[0] == 599
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_result_files_with_bom_and_padded_header(spark, tmp_path):
    (tmp_path / "x_RESULTADO.csv").write_text("﻿RUT ;DV; TELEFONE_VALIDADO;EMAIL_VALIDADO;SUCESSO;ERRO\n1;2;;;0;x\n", encoding="utf-8")
    df = files.read_results(spark, f"{tmp_path}/*_RESULTADO.csv")
    assert df.columns == ["rut", "dv", "telefone_validado", "email_validado", "sucesso", "erro"]
    assert df.first().erro == "x" and df.first().telefone_validado == ""


def test_result_columns_go_by_name_in_each_file(spark, tmp_path):
    (tmp_path / "a b_RESULTADO.csv").write_text("RUT;DV;TELEFONE_VALIDADO;EMAIL_VALIDADO;SUCESSO;ERRO\n1;2;911;a@b;1;\n")
    (tmp_path / "b_RESULTADO.csv").write_text("\ufeffEMAIL_VALIDADO;TELEFONE_VALIDADO;RUT;SUCESSO\nc@d;922;3;1\n", encoding="utf-8")
    (tmp_path / "c_RESULTADO.csv").write_text("")
    df = files.read_results(spark, f"{tmp_path}/*_RESULTADO.csv")
    got = {r.rut: (r.dv, r.telefone_validado, r.email_validado, r.erro) for r in df.collect()}
    assert got == {"1": ("2", "911", "a@b", ""), "3": ("", "922", "c@d", "")}
    lines = files.with_line_no(files.read_results(spark, f"{tmp_path}/*_RESULTADO.csv", positions=True))
    assert {r.rut: r.line_no for r in lines.collect()} == {"1": 0, "3": 1}


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "c.txt").write_bytes(b'rut;direccion\n1;"a\nb"\n2;c\n')
    got = files.read_customers(spark, str(tmp_path / "c.txt"), multiline=True).orderBy("rut").collect()
    assert [tuple(r) for r in got] == [("1", "a\nb"), ("2", "c")]


def test_missing_files(spark, tmp_path):
    assert files.read_results(spark, f"{tmp_path}/*_RESULTADO.csv").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_results(spark, f"{tmp_path}/none.csv")


def test_export_bytes(spark, tmp_path):
    df = spark.createDataFrame([("1", None, "", "a;b", ' "q"')], "RUT string, DV string, NOME string, X string, Y string")
    path = files.write_delimited(df, str(tmp_path / "out"), bom=True, single_file=True)
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_bytes() == b'\xef\xbb\xbfRUT;DV;NOME;X;Y\n1;;;"a;b"; "q"\n' or part.read_bytes() == b'\xef\xbb\xbfRUT;DV;NOME;X;Y\n1;;;"a;b";" ""q"""\n'
    back = files.read_delimited(spark, path).first()
    assert tuple(back) == ("1", "", "", "a;b", ' "q"')
    assert files.export_path("x", dt.date(2026, 2, 28)) == "x/extracao_2026-02-28.csv"
    assert len(EXPORT_FILE) == 16


def test_lines_without_key_are_written_unchanged(spark):
    schema = "rut string, region string, comuna string, direccion string"
    raw = spark.createDataFrame([("x", "CHILE", "DEPTO", " a "), (None, None, "DEPTO", None), ("1", "CHILE", "DEPTO", " a ")], schema)
    got = [tuple(r) for r in ingest.clean_customer_file(raw).collect()]
    assert got == [("x", "CHILE", "DEPTO", " a "), (None, None, "DEPTO", None), ("1", "", "", "a")]


def test_batch_handoff(spark, tmp_path):
    batch = spark.createDataFrame([(1, "10", "u", "E", "pendente", "f")], "macro_id long, cpf string, `codigo cliente` string, empresa string, status_atual string, fornecedor string")
    now = F.lit("2026-04-07").cast("timestamp_ntz")
    files.write_batch(batch, str(tmp_path / "dry"), now, dry_run=True)
    assert not (tmp_path / "dry").exists()
    where = files.write_batch(batch, str(tmp_path / "b"), now)
    work = spark.read.option("header", True).csv(where["work"])
    assert work.columns == ["cpf", "codigo cliente", "empresa"]
    assert spark.read.json(where["meta"]).first().total == 1


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
