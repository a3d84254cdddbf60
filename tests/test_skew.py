"""A client that holds a third of all rows."""

import pytest
from pyspark.sql import functions as F

from contactflow.operators import contracts, export, ingest, state, views
from contactflow.operators.keyed import spread_nulls

N = 60_000
SMALL_STAGES = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_stages(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL_STAGES}
    for k, v in SMALL_STAGES.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def hot(spark):
    client = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000)
    return spark.range(0, N, 1, 6).select("id", client.alias("cliente_id"))


def people(spark):
    return spark.range(5000).select(
        "id", (F.col("id") + 100).cast("string").alias("rut"), F.lit("1").alias("dv"), F.lit("n").alias("nome"),
        F.lit("F").alias("sexo"), F.lit(None).cast("date").alias("data_nascimento"))


def final_plan(df):
    n = df.count()
    rows = df.select(F.xxhash64(*df.columns).alias("h"))
    rows.collect()
    return n, rows._jdf.queryExecution().executedPlan().toString()


def test_state_join_splits_the_hot_client(spark, small_stages):
    rows = hot(spark).withColumn("status", F.lit("pendente"))
    n, plan = final_plan(views.with_client(rows, people(spark)))
    assert n == N
    assert "skew=true" in plan


def test_contact_listing_splits_the_hot_client(spark, small_stages):
    contacts = hot(spark).select("cliente_id", F.col("id").cast("string").alias("numero"), F.lit("validado").alias("origem"))
    none = spark.createDataFrame([], "cliente_id long, direccion string, comuna string, region string")
    emails = contacts.withColumnRenamed("numero", "endereco")
    n, plan = final_plan(export.client_contacts(people(spark), none, contacts, emails))
    assert n == 2 * N + contacts.select("cliente_id").distinct().join(people(spark), F.col("id") == F.col("cliente_id"), "right").where("cliente_id is null").count()
    assert "skew=true" in plan


def test_null_links_spread(spark):
    rows = spark.range(1000).withColumn("fk", F.lit(None).cast("long"))
    keys = rows.select(spread_nulls("fk", "id").alias("k"))
    assert keys.distinct().count() == 1000
    assert keys.where("k >= 0").count() == 0


def test_hot_contacts_shrink_before_the_join(spark):
    raw = hot(spark).select(
        F.col("id").alias("line_no"), (F.col("cliente_id") + 100).cast("string").alias("rut"),
        (F.lit(20000000) + F.col("id") % 50).cast("string").alias("celular"))
    got = ingest.resolve_contacts(raw, people(spark), "celular", ["line_no"], phone=True)
    want = raw.groupBy("rut", "celular").agg(F.min("line_no").alias("line_no")).select("line_no")
    assert got.select("line_no").exceptAll(want).count() == 0
    assert got.count() == want.count()
    assert "partial_min" in got._jdf.queryExecution().executedPlan().toString()


def test_hot_phone_cells_are_bounded_and_whole(spark):
    phones = hot(spark).select("cliente_id", F.col("id").cast("string").alias("numero"), "id")
    got = contracts.phone_text(phones, max_cell=1000)
    sizes = got.select("cliente_id", F.size(F.split("telefones", ";")).alias("n"))
    assert sizes.agg(F.max("n"), F.sum("n")).first()[:][1] == N
    assert sizes.agg(F.max("n")).first()[0] <= 2000
    assert sizes.where("cliente_id = 1").count() > 5


def test_longer_phone_lists_make_more_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        phones = spark.range(0, 2_000_000, 1, 4).select(
            (F.col("id") % 300_000).alias("cliente_id"), F.sha2(F.col("id").cast("string"), 256).substr(1, 20).alias("numero"), "id")
        tasks = contracts.phone_rows(phones).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert tasks > 6  # without a bound on what a task reads: about one for each of 4 cores


def test_hot_client_results_against_brute_force(spark):
    codes = ["1", "0", ""]
    rows = [(i, str(101 if i % 3 == 0 else 100 + i % 50), codes[(i * 7) % 3], "", "", "timeout" if i % 2 else "x") for i in range(3000)]
    results = spark.createDataFrame(rows, "line_no long, rut string, sucesso string, telefone_validado string, email_validado string, erro string")
    want = {}
    for _, rut, ok, _, _, err in rows:
        if want.get(rut) != 2:
            want[rut] = 2 if ok == "1" else 4 if err == "timeout" else 5
    assert {r.rut: r.resposta_id for r in state.resolve_results(results, ["line_no"]).collect()} == want
