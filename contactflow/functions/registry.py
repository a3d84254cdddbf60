"""The scalar functions as temporary SQL functions, written in SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .fixed_values import (
    BAD_FIRST_CHARS,
    BODY_TEXT_RULES,
    CATALOGUE_STATUS,
    COMMUNE_CORRECTIONS,
    CONNECTION_ERRORS,
    CONTRACT_OUTCOMES,
    EMPTY_BODY_OUTCOME,
    INVALID_REGIONS,
    REGION_PREFIXES,
    REGISTERED_USER_ERRORS,
    TRUNCATED_REGIONS,
    UNKNOWN_BODY_OUTCOME,
    VALID_REGIONS,
)
from .text import FOLD_FROM, FOLD_TO, WHITESPACE


def _q(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _list(values) -> str:
    return ", ".join(_q(v) for v in values)


def _map(pairs: dict) -> str:
    return "map(" + ", ".join(f"{_q(k)}, {_q(v)}" for k, v in pairs.items()) + ")"


def _trim(v: str) -> str:
    return f"btrim({v}, {_q(WHITESPACE)})"


def _any(text: str, fragments) -> str:
    return "(" + " OR ".join(f"contains({text}, {_q(f)})" for f in fragments) + ")"


def definitions() -> dict[str, str]:
    """Signature and body per function."""
    digits = "regexp_replace(v, '[^0-9]', '')"
    phone = f"CASE length({digits}) WHEN 8 THEN '9' || {digits} WHEN 9 THEN {digits} END"
    bare = f"trim(LEADING {_q(WHITESPACE)} FROM translate({_trim('v')}, '.-', ''))"
    word = f"nullif(regexp_extract({bare}, '(?U)^([0-9]+)(?:\\\\s|$)', 1), '')"
    rut = f"CASE WHEN {word} IS NOT NULL THEN coalesce(nullif(trim(LEADING '0' FROM {word}), ''), '0') END"
    region = (
        f"(SELECT CASE WHEN r IN ({_list(VALID_REGIONS)}) AND r NOT IN ({_list(INVALID_REGIONS)}) THEN r END"
        f" FROM (SELECT coalesce(try_element_at({_map(TRUNCATED_REGIONS)}, t), t) AS r FROM (SELECT {_trim('v')} AS t)))"
    )
    commune = f"""(SELECT CASE WHEN NOT ok OR length(c) < 3 THEN NULL
          WHEN k IN ({_list(COMMUNE_CORRECTIONS)}) THEN try_element_at({_map(COMMUNE_CORRECTIONS)}, k)
          WHEN k IN ({_list(REGION_PREFIXES)}) THEN NULL ELSE c END
        FROM (SELECT ok, c, upper(translate(c, {_q(FOLD_FROM)}, {_q(FOLD_TO)})) AS k
        FROM (SELECT ok, CASE WHEN length(trim(TRAILING '.' FROM s)) >= 3 THEN trim(TRAILING '.' FROM s) ELSE s END AS c
        FROM (SELECT length(t) >= 3 AND NOT t RLIKE '[0-9]' AND NOT contains({_q(BAD_FIRST_CHARS)}, left(t, 1)) AS ok,
            {_trim(f"regexp_replace({_trim("regexp_replace(t, ' {2,}', ' ')")}, '\\\\.([A-Za-zÀ-ÿ])', '. $1')")} AS s
        FROM (SELECT {_trim('v')} AS t)))))"""
    result = f"""(SELECT named_struct('resposta_id', code, 'status',
          CASE WHEN code IN (1, 6) THEN 'telefone_validado'
               WHEN code IN (4, 5) THEN 'pendente' ELSE 'telefone_nao_validado' END)
        FROM (SELECT CASE
            WHEN ok AND t <> '' AND length(d) NOT IN (8, 9) THEN 8
            WHEN ok AND t <> '' AND m <> '' THEN 1 WHEN ok AND t <> '' THEN 6
            WHEN ok AND m <> '' THEN 7 WHEN ok THEN 2
            WHEN {_any('x', REGISTERED_USER_ERRORS)} THEN 3
            WHEN {_any('x', CONNECTION_ERRORS)} THEN 4 ELSE 5 END AS code
          FROM (SELECT coalesce({_trim('s')} RLIKE '^0*1$', false) AS ok, {_trim("coalesce(t, '')")} AS t,
              regexp_replace(coalesce(t, ''), '[^0-9]', '') AS d, {_trim("coalesce(m, '')")} AS m,
              lower({_trim("coalesce(x, '')")}) AS x)))"""
    return {
        "normalizar_telefone(v STRING) RETURNS STRING": phone,
        "normalizar_rut(v STRING) RETURNS STRING": rut,
        "limpar_region(v STRING) RETURNS STRING": region,
        "limpar_comuna(v STRING) RETURNS STRING": commune,
        "interpretar(s STRING, t STRING, m STRING, x STRING) "
        "RETURNS STRUCT<resposta_id: INT, status: STRING>": result,
        "interpretar_corpo(v STRING) RETURNS STRUCT<resposta_id: INT, status: STRING>": _interpret_body(),
    }


def _interpret_body() -> str:
    """The outcome of a stored response body, as `outcome.interpret_body` reads it."""
    known = {str(i): CATALOGUE_STATUS[s] for i, _, s in CONTRACT_OUTCOMES}
    texts = " ".join(f"WHEN contains(lower(t), {_q(fragment)}) THEN {_outcome(i, s)}" for fragment, i, s in BODY_TEXT_RULES)
    code = f"{_trim("get_json_object(t, '$.CodigoRetorno')")}"
    return f"""(SELECT CASE WHEN t = '' THEN {_outcome(*EMPTY_BODY_OUTCOME)}
          WHEN try_element_at({_map(known)}, k) IS NOT NULL
            THEN named_struct('resposta_id', CAST(k AS INT), 'status', try_element_at({_map(known)}, k))
          {texts} ELSE {_outcome(*UNKNOWN_BODY_OUTCOME)} END
        FROM (SELECT t, CASE WHEN startswith(t, '{{') AND endswith(t, '}}') AND c RLIKE '^[0-9]+$'
            THEN CAST(try_cast(c AS INT) AS STRING) END AS k
        FROM (SELECT t, {code} AS c FROM (SELECT {_trim("coalesce(v, '')")} AS t))))"""


def _outcome(code: int | None, status: str) -> str:
    return f"named_struct('resposta_id', CAST({'NULL' if code is None else code} AS INT), 'status', {_q(status)})"


def register(spark: SparkSession) -> None:
    for signature, body in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
