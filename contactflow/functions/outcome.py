"""Interpretation of validation answers and message texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixed_values import (
    BODY_TEXT_RULES,
    CATALOGUE_STATUS,
    CONNECTION_ERRORS,
    CONTRACT_OUTCOMES,
    DEFAULT_SUPPLIER,
    EMPTY_BODY_OUTCOME,
    ERROR_TEXT_COLUMNS,
    EXCLUDED_MESSAGES,
    HISTORIC_FILE,
    MESSAGE_COLUMNS,
    NO_ERROR_VALUES,
    OPEN_STATES,
    PENDING,
    PHONE_NOT_OK,
    PHONE_OK,
    REGISTERED_USER_ERRORS,
    REQUEST_ERROR_KEYWORDS,
    STATUS_LABELS,
    UNKNOWN_BODY_OUTCOME,
    UNKNOWN_ERROR,
    UNTRACKED_FILE,
)
from .geo import literal_map
from .identity import phone_digits
from .pages import scanned
from .text import trim_ws

FINAL_OUTCOMES = [1, 2, 3, 6, 7, 8]


def _contains_any(text: Column, fragments: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (text.contains(f) for f in fragments))


def result_code(sucesso: Column, telefone: Column, email: Column, erro: Column) -> Column:
    """Outcome id 1-8 of one result line."""
    def filled(c):
        return F.coalesce(trim_ws(c) != "", F.lit(False))

    ok = F.coalesce(trim_ws(sucesso).rlike("^0*1$"), F.lit(False))
    error = F.lower(trim_ws(F.coalesce(erro, F.lit(""))))
    has_phone, has_email = filled(telefone), filled(email)
    return (
        F.when(ok & has_phone & (phone_digits(telefone) == ""), 8)
        .when(ok & has_phone & has_email, 1)
        .when(ok & has_phone, 6)
        .when(ok & has_email, 7)
        .when(ok, 2)
        .when(_contains_any(error, REGISTERED_USER_ERRORS), 3)
        .when(_contains_any(error, CONNECTION_ERRORS), 4)
        .otherwise(5)
    )


def code_status(code: Column) -> Column:
    """State a client moves to; retryable outcomes go back to the queue."""
    return (
        F.when(code.isin(1, 6), PHONE_OK).when(code.isin(2, 3, 7, 8), PHONE_NOT_OK).otherwise(PENDING)
    )


def interpret_result(sucesso: Column, telefone: Column, email: Column, erro: Column) -> Column:
    code = result_code(sucesso, telefone, email, erro)
    return F.struct(code.alias("resposta_id"), code_status(code).alias("status"))


def catalogue_state(status: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(CATALOGUE_STATUS), status), F.lit("reprocessar"))


def body_code(body: Column) -> Column:
    """Numeric return code of a JSON object body, else NULL."""
    text = trim_ws(body)
    code = trim_ws(F.get_json_object(text, "$.CodigoRetorno"))
    is_object = text.startswith("{") & text.endswith("}")
    return F.when(is_object & code.rlike("^[0-9]+$"), code.try_cast("int"))


def interpret_body(
    body: Column, known_code: Column | None = None, known_status: Column | None = None
) -> Column:
    """Outcome of a stored response body.

    `known_code` / `known_status` are columns of a joined catalogue; a hit
    there wins over the built-in codes.
    """
    text = trim_ws(F.coalesce(body, F.lit("")))
    lower = F.lower(text)
    code = body_code(body)
    builtin = {str(i): CATALOGUE_STATUS[s] for i, _, s in CONTRACT_OUTCOMES}
    builtin_status = F.try_element_at(literal_map(builtin), code.cast("string"))

    def out(i, s):
        i = i if isinstance(i, Column) else F.lit(i)
        s = s if isinstance(s, Column) else F.lit(s)
        return F.struct(i.cast("int").alias("resposta_id"), s.alias("status"))

    chain = F.when(text == "", out(*EMPTY_BODY_OUTCOME))
    if known_code is not None:
        chain = chain.when(known_code.isNotNull(), out(known_code, catalogue_state(known_status)))
    chain = chain.when(builtin_status.isNotNull(), out(code, builtin_status))
    for fragment, i, status in BODY_TEXT_RULES:
        chain = chain.when(lower.contains(fragment), out(i, status))
    return chain.otherwise(out(*UNKNOWN_BODY_OUTCOME))


def interpret_bodies(df: DataFrame, body: str, catalogue: DataFrame | None = None) -> DataFrame:
    """Adds resposta_id and status; the catalogue maps an id of any size to its status.

    The catalogue is reduced to one row per id; the planner chooses the join.
    """
    if catalogue is None:
        return df.withColumn("_o", interpret_body(F.col(body))).select("*", "_o.*").drop("_o")
    known = (
        catalogue.where(F.col("id").isNotNull())
        .groupBy(F.col("id").cast("int").alias("_code"))
        .agg(F.min("status").alias("_status"))
    )
    joined = df.withColumn("_key", body_code(F.col(body))).join(
        known, F.col("_key") == F.col("_code"), "left"
    )
    outcome = interpret_body(F.col(body), F.col("_code"), F.col("_status"))
    return (
        joined.withColumn("_o", outcome).select("*", "_o.*").drop("_o", "_key", "_code", "_status")
    )


def status_label(status: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(STATUS_LABELS), status), status)


def is_request_error(df: DataFrame, message: str | None = None, null_is_error: bool = False) -> Column:
    """Error flag from the structured Error column and the text columns present."""
    flag = F.lit(False)
    if "Error" in df.columns:
        value = F.upper(trim_ws(F.col("Error")))
        flag = F.coalesce(~value.isin(NO_ERROR_VALUES), F.lit(null_is_error))
    names = [c for c in [message, *ERROR_TEXT_COLUMNS] if c and c in df.columns]
    names = list(dict.fromkeys(names))
    if names:
        text = F.concat_ws(" ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names))
        words = "|".join(REQUEST_ERROR_KEYWORDS)
        flag = flag | text.rlike(f"(?i)(?:{words})") | text.rlike(r"\b5[0-9]{2}\b")
    return flag


def pick_message_column(df: DataFrame) -> str | None:
    return next((c for c in MESSAGE_COLUMNS if c in df.columns), None)


def reportable_message(message: Column) -> Column:
    return F.coalesce(~F.upper(trim_ws(message)).isin(EXCLUDED_MESSAGES), F.lit(False))


def supplier_or_default(c: Column) -> Column:
    return F.coalesce(c, F.lit(DEFAULT_SUPPLIER))


def origin_file(
    entered: Column,
    filename: Column,
    historic: str = HISTORIC_FILE,
    untracked: str = UNTRACKED_FILE,
) -> Column:
    return F.when(entered.isNull(), F.lit(historic)).otherwise(F.coalesce(filename, F.lit(untracked)))


def rename_code(c: Column, renames: dict[str, str]) -> Column:
    return F.coalesce(F.try_element_at(literal_map(renames), c), c)


def is_open(status: Column) -> Column:
    return status.isin(OPEN_STATES)


def is_unresolved(status: Column, resposta_id: Column) -> Column:
    """Left the queue without an outcome: an invalid state."""
    return (status != PENDING) & resposta_id.isNull()


def landed_fields(body: Column) -> Column:
    """Result fields of a stored answer page: JSON reason, form inputs or alert."""
    reason = F.get_json_object(body, "$.motivoRetorno")
    page = scanned(body)
    found = page["fone"].isNotNull() & page["email"].isNotNull() & reason.isNull()
    empty = F.lit("")
    return F.struct(
        F.when(found, page["fone"]).otherwise(empty).alias("telefone_validado"),
        F.when(found, page["email"]).otherwise(empty).alias("email_validado"),
        F.when(found, F.lit("1")).otherwise(F.lit("0")).alias("sucesso"),
        F.when(reason.isNotNull(), reason)
        .when(found, empty)
        .otherwise(F.coalesce(page["alerta"], F.lit(UNKNOWN_ERROR)))
        .alias("erro"),
    )
