"""Small changes write small: logs, buckets, commits of several tables, and writers that die."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from contactflow.operators import ingest, state
from contactflow.operators.keyed import update_join, upsert
from contactflow.plans import jobs
from contactflow.plans.fixtures import Inputs
from contactflow.schemas import TABLES
from contactflow.sources.catalog import BUCKET, Catalog, Conflict, bucket_of
from contactflow.streaming import jobs as streams

NOW = dt.datetime(2026, 4, 7, 12)
PAIR = "id long, v string"


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def written(folder, table):
    """Rows of each folder of a table, in the order of their versions."""
    import pyarrow.parquet as pq

    folders = sorted(Path(folder, table).iterdir(), key=lambda p: int(p.name.split("-")[0]))
    return [sum(pq.ParquetFile(f).metadata.num_rows for f in p.rglob("*.parquet")) for p in folders]


def test_a_log_holds_the_changed_rows_only(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    with catalog.commit() as c:
        c.replace("t", spark.range(1000).selectExpr("id", "'old' AS v"), key="id")
    for n in range(3):
        with catalog.commit() as c:
            c.change("t", spark.createDataFrame([(n, f"new{n}"), (7, f"seven{n}"), (2000 + n, "added")], PAIR), "id")
    assert written(tmp_path, "t") == [1000, 3, 3, 3]
    got = {r.id: r.v for r in catalog.read("t", PAIR).collect()}
    assert len(got) == 1003 and (got[0], got[2], got[7], got[2001], got[500]) == ("new0", "new2", "seven2", "added", "old")
    before = rows(catalog.read("t", PAIR))
    catalog.fold("t", PAIR)
    assert rows(catalog.read("t", PAIR)) == before and catalog.version()["tables"]["t"]["log"] == []
    assert catalog.clean() == 4 and rows(catalog.read("t", PAIR)) == before


def test_one_commit_publishes_all_tables_or_none(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    with pytest.raises(ZeroDivisionError), catalog.commit() as c:
        c.append("a", spark.range(3))
        c.append("b", spark.range(3))
        raise ZeroDivisionError
    assert not catalog.holds("a") and catalog.version()["number"] == 0
    with pytest.raises(Conflict), catalog.commit() as c:
        c.append("a", spark.range(3))
        with catalog.commit() as other:
            other.append("b", spark.range(2))
    assert not catalog.holds("a") and catalog.read("b", "id long").count() == 2


def test_a_pointer_that_lags_behind_is_caught_up(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    for n in range(3):
        with catalog.commit() as c:
            c.append("t", spark.range(n, n + 1))
    (tmp_path / "versions" / "newest").write_text("1")
    (tmp_path / "versions" / ".newest.crc").unlink(missing_ok=True)
    assert catalog.version()["number"] == 3 and catalog.read("t", "id long").count() == 3


def test_a_batch_is_applied_once(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    for batch in (0, 1, 1, 0):
        with catalog.commit("stream", batch) as c:
            if not c.replayed:
                c.append("t", spark.range(1))
    assert catalog.read("t", "id long").count() == 2


def test_an_update_by_key_keeps_the_files_of_other_buckets(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    stored = spark.range(5000).selectExpr("id", "'old' AS v")
    with catalog.commit() as c:
        c.put_buckets("t", stored, ["id"], 32)
    before = catalog.version()["tables"]["t"]["buckets"]
    delta = spark.createDataFrame([(3, "x"), (77, None), (9999, "absent")], PAIR)
    with catalog.commit() as c:
        touched = c.update("t", PAIR, delta, ["id"], 32, lambda t, d: update_join(t, d, ["id"], ["v"]))
    after = catalog.version()["tables"]["t"]["buckets"]
    assert len(touched) <= 3 and {n for n in before if before[n] != after[n]} == set(map(str, touched))
    assert rows(catalog.read("t", PAIR)) == rows(update_join(stored, delta, ["id"], ["v"]))
    plan = catalog.read_buckets("t", PAIR, touched)
    assert len(plan.inputFiles()) <= 2 * len(touched)
    with catalog.commit() as c:
        c.update("t", PAIR, delta, ["id"], 32, lambda t, d: upsert(t, d, ["id"]))
    assert rows(catalog.read("t", PAIR)) == rows(upsert(update_join(stored, delta, ["id"], ["v"]), delta, ["id"]))
    with pytest.raises(ValueError), catalog.commit() as c:
        c.put_buckets("t", stored, ["id"], 8)
    with catalog.commit() as c:  # a bucket that is left empty
        c.update("t", PAIR, stored, ["id"], 32, lambda t, d: t.limit(0))
    assert catalog.read("t", PAIR).count() == 0


def test_claims_results_and_exports_write_their_rows_only(spark, sf_dir, tmp_path):
    i = Inputs(spark, sf_dir)
    store = jobs.Store(spark, str(tmp_path))
    with store.catalog.commit() as c:
        store.append(c, "clients", i.clients)
    jobs.seed_state(store, NOW)
    n = i.clients.count()
    jobs.claim_batch(store, 20).count()
    assert written(tmp_path, "state") == [n, 20]
    whole = state.claim(state.revert(store.read("state")), store.read("state").where("status = 'processando'"))
    assert rows(store.read("state")) == rows(whole)
    assert jobs.revert_claims(store, [1, 2]) <= 2 and jobs.revert_claims(store) >= 18
    assert store.read("state").where("status = 'processando'").count() == 0
    for _ in range(16):
        jobs.claim_batch(store, 1)
    assert len(store.catalog.version()["tables"]["state"]["log"]) <= 16  # folded
    assert store.read("state").count() == n


@pytest.mark.parametrize("by_id", [True, False])
def test_deltas_equal_the_whole_tables(spark, sf_dir, by_id):
    i = Inputs(spark, sf_dir)
    now = F.lit(NOW.isoformat(sep=" ")).cast("timestamp_ntz")
    current = i.work_state_u
    if by_id:
        ids = current.where("id % 5 = 0")
        pairs = [
            (state.claimed_rows(current, ids), state.claim(current, ids)),
            (state.reverted_rows(current, ids), state.revert(current, ids)),
            (state.reverted_rows(current), state.revert(current)),
            (state.consumed_rows(current, ids, now), state.consume(current, ids, now)),
        ]
    else:
        pairs = [(state.result_rows(current, i.macro_result, i.clients, ["line_no"], now), state.apply_results(current, i.macro_result, i.clients, ["line_no"], now))]
    for delta, whole in pairs:
        assert rows(current.join(delta, "id", "left_anti").unionByName(delta)) == rows(whole)
        assert delta.count() < whole.count()


def test_addresses_are_updated_in_their_buckets(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path / "base"))
    customers = tmp_path / "c.txt"
    lines = [f"{1000 + k};1;N{k};F;CALLE {k};MAIPU;RM;" for k in range(300)]
    customers.write_text("rut;dv;nombre;sexo;direccion;comuna;region;FECHA NAC\n" + "\n".join(lines) + "\n", encoding="latin-1")
    jobs.import_customers(store, str(customers), NOW)
    before = store.catalog.version()["tables"]["addresses"]["buckets"]
    fix = tmp_path / "fix.txt"
    fix.write_text("rut;dv;nombre;sexo;direccion;comuna;region;FECHA NAC\n1007;1;N;F;NEW 7;;;\n1009;1;N;F;NEW 9;;;\n")
    jobs.update_addresses(store, str(fix))
    after = store.catalog.version()["tables"]["addresses"]["buckets"]
    assert 1 <= sum(before[n] != after[n] for n in before) <= 2
    got = store.read("addresses")
    assert got.count() == 300 and got.where("direccion LIKE 'NEW%'").count() == 2


def test_an_import_that_fails_half_way_publishes_nothing(spark, tmp_path, monkeypatch):
    store = jobs.Store(spark, str(tmp_path / "base"))
    customers = tmp_path / "c.txt"
    customers.write_text("rut;dv;nombre;sexo;direccion;comuna;region;FECHA NAC\n1000;1;A;F;X;;;\n", encoding="latin-1")

    def status():
        return [r.status for r in store.read("imports").orderBy("id").collect()]

    def broken(*args):
        raise OSError("disk gone")

    with monkeypatch.context() as m:
        m.setattr(ingest, "new_addresses", broken)  # clients and ledger rows are written by then
        with pytest.raises(OSError):
            jobs.import_customers(store, str(customers), NOW)
    assert status() == ["failed"] and store.read("clients").count() == 0 and store.read("import_rows").count() == 0

    with monkeypatch.context() as m:
        m.setattr(jobs, "_publish_customers", broken)
        m.setattr(jobs, "close_lost_imports", lambda *args: 0)  # the process is gone before it can close
        with pytest.raises(OSError):
            jobs.import_customers(store, str(customers), NOW)
    assert status() == ["failed", "processing"]
    assert jobs.import_customers(store, str(customers), NOW)["clientes_inseridos"] == 1
    assert status() == ["failed", "failed", "completed"] and store.read("clients").count() == 1
    assert store.read("imports").where("status = 'failed' AND finished_at IS NOT NULL").count() == 2


def test_quoted_line_breaks_are_one_line_for_the_jobs(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path / "base"))
    customers = tmp_path / "c.txt"
    customers.write_text('rut;dv;nombre;sexo;direccion;comuna;region;FECHA NAC\n1000;1;A;F;"X\nY";;;\n2000;1;B;F;Z;;;\n', encoding="latin-1")
    assert jobs.import_customers(store, str(customers), NOW, multiline=True)["lidos"] == 2
    assert store.read("clients").count() == 2


def test_a_first_wins_batch_opens_its_own_buckets(spark, tmp_path, monkeypatch):
    opened = []
    read = Catalog.read_buckets
    monkeypatch.setattr(Catalog, "read_buckets", lambda self, name, schema, numbers, version=None: opened.append(list(numbers)) or read(self, name, schema, numbers, version))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run(ids):
        df = spark.createDataFrame([(k, n) for n, k in enumerate(ids)], "k long, line_no long").coalesce(1)
        streams.first_wins(spark, streams.land(df, str(tmp_path / "in")), out, checkpoint, ["k"], ["line_no"], buckets=64)

    run(range(200))
    opened.clear()
    run([5, 5, 1000])
    want = {r[0] for r in spark.createDataFrame([(5,), (1000,)], "k long").select(bucket_of(["k"], 64)).collect()}
    assert opened and all(set(numbers) <= want for numbers in opened)
    assert spark.read.parquet(f"{out}/batch=1").count() == 1
    memory = Catalog(spark, f"{checkpoint}-keys")
    files = memory.read_buckets("keys", "k long", sorted(want)).inputFiles()
    assert all(int(f.split(f"{BUCKET}=")[1].split("/")[0]) in want for f in files)


def test_a_first_wins_batch_that_died_before_its_keys_writes_the_same_rows(spark, tmp_path, monkeypatch):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    source = streams.land(spark.range(50).selectExpr("id % 20 AS k", "id AS line_no").coalesce(1), str(tmp_path / "in"))
    with monkeypatch.context() as m:
        m.setattr(Catalog, "publish", lambda self, manifest: 1 / 0)
        with pytest.raises(Exception):
            streams.first_wins(spark, source, out, checkpoint, ["k"], ["line_no"])
    streams.first_wins(spark, source, out, checkpoint, ["k"], ["line_no"])
    assert spark.read.parquet(f"{out}/batch=0").count() == 20
    # What was published is left alone when its batch comes again.
    with Catalog(spark, f"{checkpoint}-keys").commit("rows", 0) as c:
        assert c.replayed


def test_key_buckets_of_many_batches_are_folded(spark, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for n in range(19):
        source = streams.land(spark.createDataFrame([(n, 0), (0, 1)], "k long, line_no long").coalesce(1), str(tmp_path / "in"))
        streams.first_wins(spark, source, out, checkpoint, ["k"], ["line_no"], buckets=1)
    assert spark.read.parquet(f"{out}/*").count() == 19
    assert len(Catalog(spark, f"{checkpoint}-keys").version()["tables"]["keys"]["buckets"]["0"]) <= 17


def test_tables_never_written_are_empty(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    assert all(store.read(name).count() == 0 for name in TABLES)
