"""Ingest, export, report and contract rules on small tables with a hot key."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from contactflow.operators import contracts, export, ingest, quality, report, rollups


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_staging_statuses(spark):
    raw = spark.createDataFrame(
        [(0, "1", "A", "1"), (1, "", "B", "1"), (2, "x", "C", "1"), (3, "123456789", "D", "k"), (4, "01", "E", "1"), (5, "7", "F", "1"), (6, None, "G", "1")],
        "line_no long, rut string, nombre string, dv string")
    got = ingest.stage_rows(raw, spark.createDataFrame([("7",)], "rut string"))
    assert rows(got, "line_no", "validation_status", "validation_message") == [
        (0, "valid", None), (1, "invalid", "blank key"), (2, "invalid", "key is not numeric"), (3, "invalid", "key is too long"),
        (4, "skipped", "key repeated in file"), (5, "skipped", "key already stored"), (6, "invalid", "blank key")]
    assert rows(ingest.rejected_rows(raw), "line_no") == [(1,), (2,), (3,), (6,)]


def test_contact_slots_against_brute_force(spark):
    data = [(0 if i % 3 == 0 else i % 40, f"n{i % 17}", "validado" if i % 5 == 0 else "enriquecimento", i) for i in range(2000)]
    df = spark.createDataFrame(data, "cliente_id long, numero string, origem string, id long")
    want = {}
    for c, n, o, i in data:
        want.setdefault(c, []).append((o != "validado", i, n))
    want = {c: [n for *_, n in sorted(v)][:5] for c, v in want.items()}
    got = export.contact_slots(df, "numero", "telefone", 5, ["id"]).collect()
    assert {r[0]: [x for x in r[1:] if x is not None] for r in got} == want


def test_client_contacts_stay_linear(spark):
    clients = spark.createDataFrame([(1, "1", "1", "A", "F", None), (2, "2", "2", "B", "M", None)], "id long, rut string, dv string, nome string, sexo string, data_nascimento date")
    addresses = spark.createDataFrame([(1, "d", "c", "r")], "cliente_id long, direccion string, comuna string, region string")
    phones = spark.createDataFrame([(1, f"p{i}", "validado") for i in range(300)], "cliente_id long, numero string, origem string")
    emails = spark.createDataFrame([(1, f"e{i}", "validado") for i in range(300)], "cliente_id long, endereco string, origem string")
    got = export.client_contacts(clients, addresses, phones, emails)
    assert got.count() == 602
    assert got.where("cliente_id = 2").first().tipo is None


def test_phone_text_splits_large_clients_and_keeps_all(spark):
    data = [(1, f"{i:05d}", i) for i in range(100)] + [(1, "00003", 400), (2, "9", 7), (2, "8", 9), (2, "9", 8)]
    df = spark.createDataFrame(data, "cliente_id long, numero string, id long")
    got = contracts.phone_text(df, max_cell=30).orderBy("cliente_id", "parte").collect()
    assert got[-1].telefones == "9;8" and got[-1].parte == 0
    cells = [r.telefones.split(";") for r in got if r.cliente_id == 1]
    assert all(len(c) <= 30 for c in cells)
    assert sum(cells, []) == [f"{i:05d}" for i in range(100)]


def test_many_phones_do_not_multiply_report_rows(spark):
    n = 500_001
    phones = spark.range(n).select(
        F.lit(1).cast("long").alias("cliente_id"), F.lpad(F.col("id").cast("string"), 6, "0").alias("numero"), "id"
    ).union(spark.createDataFrame([(2, "8", 9), (2, "9", 7), (2, "9", 8), (3, "1", 5)], "cliente_id long, numero string, id long"))
    clients = spark.createDataFrame([(1, "c1", "A"), (2, "c2", "B"), (3, "c3", "C")], "id long, cpf string, nome string")
    companies = spark.createDataFrame([(0, "D0")], "id int, nome string")
    units = spark.createDataFrame([(5, "u5", 1, 0), (6, "u6", 2, 0)], "id long, uc string, cliente_id long, distribuidora_id int")
    addresses = spark.createDataFrame([], "id long, cliente_id long, distribuidora_id int, endereco string, numero string, complemento string, bairro string, cidade string, uf string, cep string")
    data = [(10, 1, 0, 5, 3, "consolidado"), (11, 2, 0, 6, 3, "consolidado"), (12, 1, 0, None, 3, "pendente")]
    state = spark.createDataFrame(data, "id long, cliente_id long, distribuidora_id int, cliente_uc_id long, resposta_id int, status string")
    history = spark.createDataFrame([("c1", "h1", "0", "3"), ("c1", "h2", "0", "3")], "cpf string, uc string, distribuidora_id string, resposta_id string")
    catalogue = spark.createDataFrame([(3, contracts.ACTIVE_CONTRACT_MESSAGE)], "id int, mensagem string")

    size, whole = F.length("telefones"), F.sha2("telefones", 256)
    text = "; ".join(f"{i:06d}" for i in range(n))
    report = contracts.active_contract_report(state, clients, units, companies, addresses, phones, catalogue)
    assert [tuple(r) for r in report.select("cpf", "uc_ativa", size, whole).collect()] == [
        ("c1", "u5", len(text), hashlib.sha256(text.encode()).hexdigest()), ("c2", "u6", 4, hashlib.sha256(b"9; 8").hexdigest())]

    title = contracts.provenance_report(state, clients, companies, units, addresses, phones, history)
    long = 7 * n - 1
    assert sorted(map(tuple, title.select("cpf", "uc", "origem_uc", size).collect())) == [
        ("c1", "h1", "historico_multiplo", long), ("c1", "h2", "historico_multiplo", long),
        ("c1", "u5", "cliente_uc_id", long), ("c2", "u6", "cliente_uc_id", 3)]


def test_history_tags(spark):
    history = spark.createDataFrame([("1", "u1", "0", "3"), ("1", "u1", "0", "3"), ("2", "u2", "1", "3"), ("2", "u3", "1", "3"), ("3", "u4", "0", "4")], "cpf string, uc string, distribuidora_id string, resposta_id string")
    data = spark.createDataFrame([(10, "1", 0), (20, "2", 1), (30, "3", 0), (40, "1", 1)], "id long, cpf string, distribuidora_id int")
    assert rows(contracts.resolve_by_history(data, history), "id", F.coalesce("uc", F.lit("")), "origem_uc") == [
        (10, "u1", "historico_unico"), (20, "u2", "historico_multiplo"), (20, "u3", "historico_multiplo"),
        (30, "", "sem_historico"), (40, "", "sem_historico")]


def rollup(spark):
    day = dt.date
    return spark.createDataFrame(
        [(day(2026, 4, 1), "telefone_validado", "m1 ", 1), (day(2026, 4, 1), "telefone_nao_validado", "m2", 7),
         (day(2026, 5, 2), "telefone_validado", "m1", 2), (day(2026, 5, 2), "outro", None, 1)],
        "dia date, status string, mensagem string, qtd long")


def test_summary_and_total(spark):
    got = rollups.summary_with_total(rollups.daily_summary(rollup(spark)))
    cols = ("dia", "total", "ativos", "inativos", "pct_ativos", "pct_inativos")
    assert rows(got, *cols) == [
        ("2026-04-01", 8, 1, 7, "12.5%", "87.5%"), ("2026-05-02", 3, 2, 0, "66.7%", "0.0%"), ("Total", 11, 3, 7, "27.3%", "63.6%")]
    assert rows(quality.unbalanced_days(got), "n_linhas", "n_violacoes") == [(2, 1)]
    assert quality.total_row_check(got).first().ok
    one = rollups.summary_with_total(rollups.daily_summary(rollups.select_days(rollup(spark), ["2026-04-01"])))
    assert rows(one, "dia") == [("2026-04-01",)]


def test_day_selection(spark):
    r = rollup(spark)
    assert rollups.select_days(r, None).count() == 4
    assert rollups.select_days(r, ["mes:2026-04"]).count() == 2
    assert rollups.select_days(r, ["mes:2030-01"]).count() == 4
    assert rollups.select_days(r, ["2030-01-01"]).count() == 0
    assert rollups.select_days(r, ["mes:2030-01", "2026-05-02"]).count() == 2


def test_message_distribution(spark):
    assert rows(rollups.message_distribution(rollup(spark)), "mensagem", "quantidade") == [("m1", 3), ("m2", 7)]
    api = rollups.dashboard(rollup(spark), rollup(spark).groupBy("status").agg(F.sum("qtd").alias("qtd")), days=["mes:2026-04"])
    assert rows(api["distribution"], "mensagem", "quantidade") == [("outro", 1), ("telefone_nao_validado", 7), ("telefone_validado", 3)]


def test_file_statistics_fill_missing(spark):
    stats = spark.createDataFrame([("f", "2026-04-01", 10, 4, None), ("g", "2026-04-01", 3, 0, 1)], "arquivo string, data_carga string, ucs_ineditas int, combos_processadas int, combos_ativas int")
    got = report.file_statistics(stats).orderBy("arquivo").collect()
    assert (got[0].combos_pendentes, got[0].pct_combos_ativas, got[0].cpfs_no_arquivo) == (6, "0.0%", 0)
    assert (got[1].combos_pendentes, got[1].pct_combos_ativas) == (3, "-")


def test_counters_add_up(spark, sf_dir):
    from contactflow.plans.fixtures import PHONE_ORDER, Inputs

    i = Inputs(spark, sf_dir)
    c = ingest.contact_counters(i.raw_phones, i.clients, i.phones, "celular", "numero", PHONE_ORDER, phone=True).first()
    assert c.lidos == c.inseridos + c.duplicados + c.sem_cliente + c.invalidos == i.raw_phones.count()
    n = ingest.import_counters(i.raw_clients, i.clients, i.addresses).first()
    assert n.lidos == n.ignorados + n.quarentena + n.clientes_inseridos + n.duplicados


def test_hot_key_counts_combine_before_the_shuffle(spark, sf_dir):
    from contactflow.operators import state
    from contactflow.plans.fixtures import Inputs

    i = Inputs(spark, sf_dir)
    plan = state.resolve_results(i.macro_result, ["line_no"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "HashAggregate" in plan
