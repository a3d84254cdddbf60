"""The daily jobs from raw files to the export, run twice where it matters."""

import datetime as dt

from contactflow.__main__ import run
from contactflow.plans.jobs import Store
from contactflow.sources.files import read_delimited

NOW = dt.datetime(2026, 4, 7, 12)
HEAD = "rut;dv;nombre;sexo;direccion;comuna;region;FECHA NAC\n"


def test_day_of_work(spark, tmp_path):
    base = str(tmp_path / "tables")

    def job(*argv):
        return run(spark, ["--base", base, *argv], NOW)

    customers = tmp_path / "base.txt"
    customers.write_bytes((
        HEAD + "1.000;k;ANA;MUJER;CALLE 1;VIÑA;DE VALPARA;20000229\n" + "x;1;BAD;M;;;;\n" + "002000;2;BETO;VARON;CALLE 2;DEPTO;CHILE;\n"
        + "1000;k;ANA 2;F;CALLE 9;;;\n" + "123456789;1;LONG;M;;;;\n").encode("latin-1"))
    assert job("--dry-run", "customers", str(customers))["clientes_inseridos"] == 2
    assert Store(spark, base).read("clients").count() == 0
    totals = job("customers", str(customers))
    assert totals == {"lidos": 5, "ignorados": 1, "quarentena": 1, "clientes_inseridos": 2, "enderecos_inseridos": 2, "duplicados": 1}
    assert job("customers", str(customers))["clientes_inseridos"] == 0
    store = Store(spark, base)
    assert sorted((r.rut, r.dv, r.nome) for r in store.read("clients").collect()) == [("1000", "K", "ANA"), ("2000", "2", "BETO")]
    assert store.read("addresses").count() == 2
    assert [(r.status, r.total_rows) for r in store.read("imports").orderBy("id").collect()] == [("completed", 5)] * 2
    assert store.read("import_rows").count() == 10

    phones = tmp_path / "cel.txt"
    phones.write_text("Rut;Celular\n1000;12345678\n1000;9-12345678\n2000;123\n9;912345678\n")
    assert job("phones", str(phones)) == {"lidos": 4, "inseridos": 1, "duplicados": 1, "sem_cliente": 1, "invalidos": 1}
    assert job("phones", str(phones))["inseridos"] == 0
    emails = tmp_path / "mail.txt"
    emails.write_text("Rut;Email\n1000;a@b\n2000; \n")
    assert job("emails", str(emails))["inseridos"] == 1

    cleaned = str(tmp_path / "cleaned")
    assert job("clean-addresses", str(customers), cleaned)["comuna_nulificada"] == 1
    assert job("update-addresses", cleaned)["sem_rut"] == 1
    got = {r.direccion: (r.comuna, r.region) for r in Store(spark, base).read("addresses").collect()}
    assert got == {"CALLE 9": (None, None), "CALLE 2": (None, None)}

    job("seed")
    assert job("claim", "--size", "10") == 2
    assert {r.status for r in Store(spark, base).read("state").collect()} == {"processando"}
    (tmp_path / "r_RESULTADO.csv").write_text(
        "﻿RUT;DV;TELEFONE_VALIDADO;EMAIL_VALIDADO;SUCESSO;ERRO\n1000;K;87654321;c@d;1;\n2000;2;;;0;Read Timeout\n77;1;;;1;\n", encoding="utf-8")
    glob = f"{tmp_path}/*_RESULTADO.csv"
    assert job("results", f"{tmp_path}/*_NONE.csv") == {}
    assert job("results", glob) == {"ok": 2, "skip": 1, "telefones": 1, "emails": 1, "clientes": 2}
    state = {r.cliente_id: (r.resposta_id, r.status) for r in Store(spark, base).read("state").collect()}
    assert sorted(state.values()) == [(1, "telefone_validado"), (4, "pendente")]
    job("results", glob)
    assert Store(spark, base).read("phones").count() == 2

    path, n = job("export", str(tmp_path / "out"))
    assert n == 1
    row = read_delimited(spark, path).first()
    assert (row.RUT, row.DATA_NASCIMENTO, row.IDADE, row.telefone_1, row.telefone_2, row.telefone_3) == (
        "1000", "29/02/2000", "26", "987654321", "912345678", "")
    assert (row.email_1, row.email_2) == ("c@d", "a@b")
    assert job("export", str(tmp_path / "again")) == (None, 0)

    where = job("refresh")
    assert {r.status: r.qtd for r in spark.read.parquet(where["status"]).collect()} == {"telefone_validado": 1, "pendente": 1}
