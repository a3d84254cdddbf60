"""Text cleaning as native column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _all_whitespace() -> str:
    return "".join(chr(cp) for cp in range(0x3001) if chr(cp).isspace())


def _fold_pairs() -> tuple[str, str]:
    """Letters with a one-character base form, then the marks to delete.

    `translate` drops a source character that has no counterpart, so the
    combining marks go last.
    """
    source, target = [], []
    for cp in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00)]:
        char = chr(cp)
        base = "".join(
            c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
        )
        if len(base) == 1 and base != char:
            source.append(char)
            target.append(base)
    marks = [chr(cp) for cp in range(0x300, 0x370) if unicodedata.combining(chr(cp))]
    return "".join(source + marks), "".join(target)


WHITESPACE = _all_whitespace()
FOLD_FROM, FOLD_TO = _fold_pairs()


def trim_ws(c: Column) -> Column:
    """Trim every Unicode blank, tabs and no-break spaces included."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def trim_truncate(c: Column, max_len: int = 255) -> Column:
    return blank_to_null(F.substring(trim_ws(c), 1, max_len))


def fold_accents(c: Column) -> Column:
    return F.upper(F.translate(c, FOLD_FROM, FOLD_TO))


def single_spaced(c: Column) -> Column:
    """One blank between words, and one after a dot that touches a letter."""
    return F.regexp_replace(F.regexp_replace(c, " {2,}", " "), r"\.([A-Za-zÀ-ÿ])", ". $1")


def normalize_spacing(c: Column) -> Column:
    return trim_ws(single_spaced(trim_ws(c)))


def sentence_case(c: Column) -> Column:
    t = trim_ws(c)
    return F.concat(F.upper(F.left(t, F.lit(1))), F.lower(F.substring(t, 2, 2147483647)))


def full_address(endereco, numero, complemento, bairro, cidade, uf, cep) -> Column:
    """Printed address; no street means no address."""
    def part(c):
        return F.coalesce(c, F.lit(""))

    return F.concat(
        endereco, F.lit(", "), part(numero), F.lit(" "), part(complemento), F.lit(", "),
        part(bairro), F.lit(", "), part(cidade), F.lit(" - "), part(uf), F.lit(" CEP: "), part(cep),
    )


def short_file_name(c: Column) -> Column:
    """Last folder and file of a path with either kind of slash."""
    tail = F.regexp_extract(c, r"([^\\/]+[\\/][^\\/]+)$", 1)
    return F.when(tail == "", c).otherwise(F.translate(tail, "\\", "/"))


def percent_text(part: Column, total: Column, when_zero: str) -> Column:
    """`12.5%`, half-even on one decimal."""
    p, t = part.cast("double"), total.cast("double")
    return F.when(total == 0, F.lit(when_zero)).otherwise(
        F.concat(F.bround(p / t * 100, 1).cast("string"), F.lit("%"))
    )
