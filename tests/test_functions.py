"""Golden tables: input and hand-worked expected value per expression."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from contactflow.functions import geo, identity, outcome, text

NB = "\u00a0"


def run(spark, expr, values, types="v string"):
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"_i int, {types}")
    return [r[0] for r in df.select("_i", expr.alias("out")).orderBy("_i").select("out").collect()]


def check(spark, expr, cases, types="v string"):
    assert run(spark, expr, [c[0] for c in cases], types) == [c[1] for c in cases]


V = F.col("v")


def test_normalize_rut(spark):
    check(spark, identity.normalize_rut(V), [
        (" 0012.345.678 ", "12345678"), ("000", "0"), ("123 456", "123"), ("12K", None),
        (".-", None), ("", None), (None, None), ("12.345.678-9", "123456789"),
        ("12345678-K", None), (f"{NB}77\t", "77"), (". 12", "12"), ("12 -", "12"), ("1²", None),
    ])
    check(spark, identity.normalize_rut(V, split_dv=True), [
        ("12.345.678-9", "12345678"), ("12345678-K", "12345678"), ("5-", "5"),
    ])


def test_dv_and_sex(spark):
    check(spark, identity.normalize_dv(V), [(" k ", "K"), ("10", None), ("Z", None), ("7", "7"), (None, None)])
    check(spark, identity.normalize_sex(V), [
        ("mujer", "F"), ("f", "F"), ("Varón", "M"), ("VARON", "M"), ("X", None), ("", None), (None, None),
    ])


def test_parse_date(spark):
    check(spark, identity.parse_date(V), [
        ("19800229", dt.date(1980, 2, 29)), ("19810229", None), ("1980-2-9", dt.date(1980, 2, 9)),
        ("1980-02-09 10:00", dt.date(1980, 2, 9)), ("09/02/1980", None), ("1980020", None),
        ("", None), (None, None), ("1980-13-01", None), ("00000101", None), (" 20240105 ", dt.date(2024, 1, 5)),
    ])


def test_phone(spark):
    check(spark, identity.normalize_phone(V), [
        ("12345678", "912345678"), ("9-1234-567 8", "912345678"), ("+56 9 1234 5678", None),
        ("12345", None), ("", None), (None, None),
    ])


def test_region(spark):
    check(spark, geo.clean_region(V), [
        ("METROPOLIT", "METROPOLITANA DE SANTIAGO"), ("DE VALPARA", "DE VALPARAÍSO"),
        ("DE VALPARAISO", "DE VALPARAISO"), ("DE NUBLE", "DE NUBLE"), (f" DEL MAULE{NB}", "DEL MAULE"),
        ("CHILE", None), ("chile", None), ("de coquimbo", None), ("", None), (None, None),
    ])


def test_commune(spark):
    cases = [
        ("Estación Centr", "ESTACION CENTRAL"), ("VIÑA", "VINA DEL MAR"), ("BIOBÍO", "BIO BIO"),
        ("POBL.P.HURTA", "POBL. P. HURTADO"), ("G.CARREÑO", "G. CARREÑO"), ("MAIPU..", "MAIPU"),
        ("maipu", "maipu"), ("LOS  ANGELES", "LOS ANGELES"), ("AB..", "AB.."), ("ÑUÑOA", "ÑUÑOA"),
        ("NUÑOA", "NUÑOA"), ("REÑACA ALTO C", "REÑACA ALTO C"), ("DEPTO", None),
        ("REGION METROPOL", None), ("CALLE 12", None), (".XYZ", None), ("AB", None), ("", None),
        (None, None), (f"{NB}maipu\t", "maipu"), ("region met", None), ("Depto.", None),
    ]
    check(spark, geo.clean_commune(V), cases)
    check(spark, geo.clean_commune(V, fold_keys=True), [
        ("REÑACA ALTO C", "REÑACA ALTO"), ("NUÑOA", "ÑUÑOA"),
    ])


def test_text(spark):
    check(spark, text.sentence_case(V), [("aTIVO now", "Ativo now"), (" x ", "X"), ("", ""), (None, None)])
    check(spark, text.fold_accents(V), [("Ñandú çà", "NANDU CA"), ("n\u0303o", "NO")])
    check(spark, text.short_file_name(V), [
        (r"C:\in\2026-04-01\a.csv", "2026-04-01/a.csv"), ("2026-04-01/a.csv", "2026-04-01/a.csv"), ("a.csv", "a.csv"),
    ])
    check(spark, text.percent_text(F.col("p"), F.col("t"), "0%"),
          [((1, 8), "12.5%"), ((1, 3), "33.3%"), ((0, 5), "0.0%"), ((0, 0), "0%"), ((49, 400), "12.2%")],
          "p int, t int")
    full = text.full_address(*(F.col(c) for c in "abcdefg"))
    check(spark, full, [
        (("R", "1", None, "B", "C", "UF", "9"), "R, 1 , B, C - UF CEP: 9"),
        ((None, "1", "x", "B", "C", "UF", "9"), None),
    ], "a string, b string, c string, d string, e string, f string, g string")


def test_age(spark):
    for day, want in [("2023-02-28", "22"), ("2023-03-01", "23"), ("2024-02-29", "24")]:
        check(spark, identity.age_on(F.col("v"), F.lit(day).cast("date")),
              [(dt.date(2000, 2, 29), want), (None, "")], "v date")
    check(spark, identity.print_date(F.col("v")), [(dt.date(2000, 2, 9), "09/02/2000"), (None, "")], "v date")


def test_interpret_result(spark):
    o = outcome.interpret_result(*(F.col(c) for c in ("s", "t", "e", "x")))
    cases = [
        (("1", "12345678", "a@b", ""), (1, "telefone_validado")),
        (("1", "12345678", "", ""), (6, "telefone_validado")),
        (("1", "", "a@b", ""), (7, "telefone_nao_validado")),
        (("1", " ", None, None), (2, "telefone_nao_validado")),
        (("1", "123", "a@b", ""), (8, "telefone_nao_validado")),
        (("0", "", "", "usuarioRegistrado"), (3, "telefone_nao_validado")),
        (("0", "", "", "ya registrado timeout"), (3, "telefone_nao_validado")),
        (("0", None, None, "Read Timeout"), (4, "pendente")),
        (("0", None, None, "x"), (5, "pendente")),
        (("", "912345678", "", ""), (5, "pendente")),
        (("2", "912345678", "", ""), (5, "pendente")),
        ((None, None, None, None), (5, "pendente")),
    ]
    got = run(spark, o, [c[0] for c in cases], "s string, t string, e string, x string")
    assert [tuple(g) for g in got] == [c[1] for c in cases]


BODIES = [
    (None, (6, "pendente")), ("", (6, "pendente")), ('{"CodigoRetorno":"003"}', (3, "consolidado")),
    ('{"CodigoRetorno":13}', (11, "reprocessar")), ("LIMIT_EXCEEDED", (11, "reprocessar")),
    ("123", (11, "reprocessar")), ("outro", (11, "reprocessar")), ('{"CodigoRetorno":10}', (10, "consolidado")),
    ('{"CodigoRetorno":"99999999999999999999"}', (11, "reprocessar")), ('{"x":1}', (11, "reprocessar")),
]


def test_interpret_body(spark):
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(BODIES)], "i int, body string")
    got = outcome.interpret_bodies(df, "body").orderBy("i").collect()
    assert [(r.resposta_id, r.status) for r in got] == [w for _, w in BODIES]
    catalogue = spark.createDataFrame([(3, "excluir"), (13, "novo")], "id int, status string")
    got = outcome.interpret_bodies(df, "body", catalogue).orderBy("i").collect()
    assert (got[2].resposta_id, got[2].status) == (3, "excluido")
    assert (got[3].resposta_id, got[3].status) == (13, "reprocessar")
    assert (got[7].resposta_id, got[7].status) == (10, "consolidado")
    wide = spark.createDataFrame([('{"CodigoRetorno":"300"}',)], "body string")
    catalogue = spark.createDataFrame([(300, "consolidado")], "id int, status string")
    assert outcome.interpret_bodies(wide, "body", catalogue).first()[1:] == (300, "consolidado")


@pytest.mark.parametrize("body,want", [
    ('{"motivoRetorno":"usuarioRegistrado"}', ("", "", "0", "usuarioRegistrado")),
    ('<p><input id="telefono" value="9 1"><input value="a&amp;b@x" id=\'correoElectronico\'></p>', ("9 1", "a&b@x", "1", "")),
    ('<input id="telefono" value=""><input id="correoElectronico" value="">', ("", "", "1", "")),
    ('<input id="telefono" value="1"><div class="alerta error"> mal <b>dato</b> </div>', ("", "", "0", "mal dato")),
    ("<html></html>", ("", "", "0", "Erro ou retorno desconhecido")),
])
def test_landed_fields(spark, body, want):
    assert tuple(run(spark, outcome.landed_fields(V), [body])[0]) == want


def test_request_error(spark):
    rows = [("ok", "0"), ("Timeout", None), ("HTTP 577", "FALSO"), ("ok", "1"), ("ok", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, mensagem string, Error string")
    def flags(**kw):
        flag = outcome.is_request_error(df, **kw)
        return [r[0] for r in df.orderBy("i").select(flag).collect()]
    assert flags() == [False, True, True, True, False]
    assert flags(null_is_error=True) == [False, True, True, True, True]


def test_normalisers_are_idempotent(spark):
    values = [" 0012.345.678 ", "000", "9-1234-5678", "VIÑA", "POBL.P.HURTA", "MAIPU..", "DE VALPARA", "x  y"]
    for fn in (identity.normalize_rut, identity.normalize_phone, geo.clean_commune, geo.clean_region):
        once = run(spark, fn(V), values)
        assert run(spark, fn(V), once) == once
