"""Answer pages as a tree parser reads them."""

import pytest
from pyspark.sql import functions as F

from contactflow.functions.outcome import landed_fields
from contactflow.functions.pages import page_fields

FORM = '<input id="telefono" value="{}"><input id="correoElectronico" value="{}">'


@pytest.mark.parametrize(
    ("body", "want"),
    [
        (FORM.format("1", "a@b"), ("1", "a@b", None)),
        ("<INPUT VALUE=1 ID=telefono><p><input type=text id='correoElectronico' value='a&amp;b&#64;c'/>", ("1", "a&b@c", None)),
        ('<input id="telefono"><input id="correoElectronico" value>', ("", "", None)),
        ('<input id="telefono" value="1"><input id="telefono" value="2">', ("1", None, None)),
        ('<input id="Telefono" value="1"><input id="telefono2" value="1">', (None, None, None)),
        ("<!-- <input id=telefono value=1> --><input id=correoElectronico value=m>", (None, "m", None)),
        ('<div class="alerta error"> a <b>b <i>c</i></b> d </div> e', (None, None, "a b c d")),
        ("<p class='x error  alerta'>&oacute;&#xBA;&nbsp;&lt;</p>", (None, None, "óº\xa0<".strip())),
        ('<div class="alerta">no</div><div class="alerta error">first</div><div class="alerta error">second</div>', (None, None, "first")),
        ('<div class="alerta error">a<div>b</div>c</div>d', (None, None, "abc")),
        ('<div class="alerta error">a<br>b<img src=x>c</div>d', (None, None, "abc")),
        ('<div class="alerta error">a<b>b</div>c', (None, None, "ab")),
        ('<div class="alerta error">a</b>b', (None, None, "ab")),
        ('<div class="alerta error">a<script>x</script><!-- y -->b</div>', (None, None, "ab")),
        ('<img class="alerta error">text', (None, None, "")),
        ('<div class="alerta-error">x</div>', (None, None, None)),
        ("", (None, None, None)),
        (None, (None, None, None)),
        ("<<<>>> & <div", (None, None, None)),
        ('<div class="alerta error">' + "<b>" * 3000 + "deep" + "</b>" * 3000 + "</div>", (None, None, "deep")),
    ],
)
def test_page_fields(body, want):
    assert tuple(page_fields(body).values()) == want


def test_landed_fields(spark):
    bodies = [FORM.format("1", "m"), '{"motivoRetorno":"x"}', '{"motivoRetorno":null}', None, "", '<i class="alerta error"></i>', FORM.format("", "")]
    df = spark.createDataFrame(list(enumerate(bodies)), "n int, body string")
    got = df.select("n", landed_fields(F.col("body")).alias("r")).select("n", "r.*").orderBy("n").collect()
    unknown = "Erro ou retorno desconhecido"
    assert [tuple(r)[1:] for r in got] == [
        ("1", "m", "1", ""), ("", "", "0", "x"), ("", "", "0", unknown), ("", "", "0", unknown), ("", "", "0", unknown), ("", "", "0", ""), ("", "", "1", ""),
    ]
