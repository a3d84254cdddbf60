"""State table rules on small hand-made tables."""

import datetime as dt

from pyspark.sql import functions as F

from contactflow.operators import state
from contactflow.operators.keyed import assign_ids, insert_ignore, rank_by_id, top_per_key, upsert
from contactflow.sources.snapshots import current_version, read_snapshot, write_snapshot

T0, T1 = dt.datetime(2026, 1, 1), dt.datetime(2026, 4, 7, 12)
STATE = "id long, cliente_id long, resposta_id int, status string, extraido int, data_extracao timestamp_ntz, data_update timestamp_ntz"
RESULT = "line_no long, rut string, sucesso string, telefone_validado string, email_validado string, erro string"

# Result lines by the outcome they lead to.
LINE = {
    1: ("1", "912345678", "a@b", ""), 2: ("1", "", "", ""), 4: ("0", "", "", "timeout"),
    5: ("0", "", "", "x"), 8: ("1", "123", "", ""),
}


def now():
    return F.lit("2026-04-07 12:00:00").cast("timestamp_ntz")


def clients(spark, n=6):
    return spark.createDataFrame([(i, str(100 + i), "1") for i in range(1, n + 1)], "id long, rut string, dv string")


def row(i, status, outcome=5):
    return (i, i, outcome, status, 0, None, T0)


def results(spark, *per_client):
    rows, n = [], 0
    for client, outcomes in per_client:
        for o in outcomes:
            rows.append((n, str(100 + client), *LINE[o]))
            n += 1
    return spark.createDataFrame(rows, RESULT)


def snapshot(df):
    return {r.cliente_id: (r.resposta_id, r.status, r.data_update, r.extraido) for r in df.collect()}


def test_apply_results_rules(spark):
    before = spark.createDataFrame(
        [row(1, "pendente"), row(2, "processando"), row(3, "pendente"), row(4, "telefone_nao_validado", 2), row(5, "pendente")], STATE
    )
    lines = results(spark, (1, [4, 1]), (2, [1, 8]), (3, [4, 5]), (4, [1]), (6, [5]), (99, [1]))
    after = state.apply_results(before, lines, clients(spark), ["line_no"], now())
    got = snapshot(after)
    assert got == {
        1: (1, "telefone_validado", T1, 0),
        2: (1, "telefone_validado", T1, 0),
        3: (5, "pendente", T1, 0),
        4: (2, "telefone_nao_validado", T1, 0),
        5: (5, "pendente", T0, 0),
        6: (5, "pendente", T1, 0),
    }
    assert after.where("cliente_id = 6").first().id > 5
    again = snapshot(state.apply_results(after, lines, clients(spark), ["line_no"], now()))
    assert {k: v[:2] for k, v in again.items()} == {k: v[:2] for k, v in got.items()}


def test_claim_revert_consume(spark):
    before = spark.createDataFrame([row(1, "pendente"), row(2, "telefone_validado", 1), row(3, "processando")], STATE)
    batch = state.id_batch(before, clients(spark), 10)
    assert [r.id for r in batch.collect()] == [1]
    claimed = state.claim(before, batch)
    assert snapshot(claimed)[1][1:3] == ("processando", T0)
    assert snapshot(state.revert(claimed, batch))[1][1] == "pendente"
    assert snapshot(state.revert(claimed, batch))[3][1] == "processando"
    assert snapshot(state.revert(claimed))[3][1] == "pendente"
    selected = state.unconsumed(before)
    used = state.consume(before, selected, now())
    assert snapshot(used)[2][3] == 1
    assert state.unconsumed(used).count() == 0


def test_guarded_contract_claim(spark):
    before = spark.createDataFrame([row(1, "pendente"), row(2, "consolidado"), row(3, "reprocessar")], STATE)
    got = snapshot(state.claim_contracts(before, before.select("id"), now()))
    assert {k: v[1:3] for k, v in got.items()} == {1: ("processando", T1), 2: ("consolidado", T0), 3: ("processando", T1)}


def test_seed_and_claimable(spark):
    before = spark.createDataFrame([row(7, "telefone_validado", 1)], STATE)
    fresh = state.seed(before, clients(spark, 3), now())
    assert [(r.id, r.cliente_id, r.status) for r in fresh.orderBy("id").collect()] == [
        (9, 1, "pendente"), (10, 2, "pendente"), (11, 3, "pendente")]
    two = spark.createDataFrame([(1, 1, 5, "pendente", 0, None, T0), (2, 1, 5, "pendente", 0, None, T1), (3, 2, 5, "pendente", 0, None, T0)], STATE)
    assert [r.id for r in state.claimable(two, clients(spark), None).collect()] == [3, 2]
    assert [r.id for r in state.claimable(two, clients(spark), 1).collect()] == [3]


def test_link_contacts(spark):
    schema = "id long, cliente_id long, status string, telefone_id long, email_id long"
    before = spark.createDataFrame([(1, 1, "telefone_validado", None, None), (2, 2, "pendente", None, 9)], schema)
    contacts = spark.createDataFrame([(5, 1, "validado"), (4, 1, "validado"), (3, 1, "enriquecimento"), (6, 2, "validado")], "id long, cliente_id long, origem string")
    got = {r.id: (r.telefone_id, r.email_id) for r in state.link_contacts(before, contacts, contacts).collect()}
    assert got == {1: (4, 4), 2: (6, 9)}


def test_insert_ignore_is_idempotent(spark):
    schema = "k string, origin string, line_no long, v string"
    target = spark.createDataFrame([("a", "x", 0, "old")], schema)
    delta = spark.createDataFrame([("a", "x", 1, "n"), ("b", "x", 3, "late"), ("b", "x", 2, "first"), ("B", "x", 4, "case")], schema)
    added = insert_ignore(target, delta, ["k", "origin"], ["line_no"])
    assert sorted((r.k, r.v) for r in added.collect()) == [("B", "case"), ("b", "first")]
    again = insert_ignore(target.unionByName(added), delta, ["k", "origin"], ["line_no"])
    assert again.count() == 0
    loose = insert_ignore(target, delta, ["k", "origin"], ["line_no"], key_collation="UNICODE_CI_AI")
    assert sorted((r.k, r.v) for r in loose.collect()) == [("b", "first")]


def test_upsert_keeps_updates_and_inserts(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, v string, n int")
    delta = spark.createDataFrame([(2, "B"), (3, "C")], "id long, v string")
    got = upsert(target, delta, ["id"], insert={"n": F.lit(0)}).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "a", 1), (2, "B", 2), (3, "C", 0)]


def test_ranks_across_ranges(spark):
    ids = [(i * 7, "h" if i % 3 else "c") for i in range(50)]
    df = spark.createDataFrame(ids, "id long, k string")
    for span in (1, 10, 1000):
        got = {r.id: r.rank for r in rank_by_id(df, "id", span=span).collect()}
        assert got == {i: n + 1 for n, (i, _) in enumerate(sorted(ids))}
        per_key = rank_by_id(df, "id", keys=("k",), span=span).collect()
        for key in "hc":
            mine = sorted(i for i, k in ids if k == key)
            assert {r.id: r.rank for r in per_key if r.k == key} == {i: n + 1 for n, i in enumerate(mine)}
    new = assign_ids(df.select(F.col("id").alias("line")), df, "line")
    assert new.agg(F.min("id"), F.max("id")).first()[:] == (344, 687)


def test_hot_key_rank_is_cut_before_the_shuffle(spark):
    df = spark.range(3000).select((F.col("id") % 3 == 0).alias("hot"), "id")
    top = top_per_key(df.select(F.when(F.col("hot"), 0).otherwise(F.col("id")).alias("k"), "id"), ["k"], ["id"], 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert [r.id for r in top.where("k = 0").orderBy("id").collect()] == [0, 3]


def test_snapshots(spark, tmp_path):
    base = str(tmp_path / "state")
    assert current_version(spark, base) is None
    assert write_snapshot(spark.range(3), base) == 0
    assert write_snapshot(read_snapshot(spark, base).where("id > 0"), base) == 1
    (tmp_path / "state" / "v=2").mkdir()  # a write that never finished
    assert current_version(spark, base) == 1
    assert read_snapshot(spark, base).count() == 2
    assert read_snapshot(spark, base, 0).count() == 3
    assert write_snapshot(spark.range(1), base) == 3
