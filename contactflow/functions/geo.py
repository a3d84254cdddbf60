"""Region and commune cleaning."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixed_values import (
    BAD_FIRST_CHARS,
    COMMUNE_CORRECTIONS,
    INVALID_REGIONS,
    REGION_PREFIXES,
    REPORT_REGIONS,
    TRUNCATED_REGIONS,
    VALID_REGIONS,
)
from .text import FOLD_FROM, FOLD_TO, blank_to_null, fold_accents, single_spaced, trim_ws

def literal_map(pairs: dict[str, str]) -> Column:
    """A constant text map; one literal to analyse, folded once per query."""
    text = "\u0001".join(f"{k}\u0002{v}" for k, v in pairs.items())
    return F.str_to_map(F.lit(text), F.lit("\u0001"), F.lit("\u0002"))


def clean_region(c: Column) -> Column:
    """Full region name, or NULL for anything outside the accepted spellings."""
    names = {r: r for r in VALID_REGIONS} | TRUNCATED_REGIONS
    accepted = {k: v for k, v in names.items() if v in VALID_REGIONS and v not in INVALID_REGIONS}
    return F.try_element_at(literal_map(accepted), trim_ws(c))


_BAD_FIRST = re.escape(BAD_FIRST_CHARS)
# Three characters or more, no digit, no rejected first character.
_USABLE = rf"^[^{_BAD_FIRST}0-9][^0-9]{{2,}}$"


def commune_value(raw: Column) -> Column:
    """Trimmed commune with even spacing; closing dots go if three characters remain."""
    return F.regexp_replace(single_spaced(raw), r"(?s)^(.{2,}[^.])\.+$", "$1")


def _targets(fold_keys: bool) -> dict[str, str]:
    """Corrected commune by folded key; a blank target means "not a commune"."""
    corrections = dict.fromkeys(REGION_PREFIXES) | COMMUNE_CORRECTIONS
    if fold_keys:
        table = str.maketrans(FOLD_FROM[: len(FOLD_TO)], FOLD_TO)
        corrections = {k.translate(table).upper(): v for k, v in corrections.items()}
    return {k: v or "" for k, v in corrections.items()}


def _commune_pick(raw: Column, value: Column, target: Column) -> Column:
    return blank_to_null(F.when(raw.rlike(_USABLE), F.coalesce(target, value)))


def clean_commune(c: Column, fold_keys: bool = False) -> Column:
    """Corrected commune, the value itself, or NULL.

    `fold_keys` also folds the correction keys, which revives those with Ñ.
    """
    raw = trim_ws(c)
    value = commune_value(raw)
    return _commune_pick(raw, value, F.try_element_at(literal_map(_targets(fold_keys)), fold_accents(value)))


def with_clean_commune(df: DataFrame, source: str, target: str, fold_keys: bool = False) -> DataFrame:
    """`clean_commune` in steps, so that no step is computed twice per row.

    The corrections, a fixed list of a few hundred, are a broadcast table that rows meet by hash.
    """
    table = df.sparkSession.createDataFrame(list(_targets(fold_keys).items()), "_key string, _target string")
    steps = df.withColumn("_raw", trim_ws(F.col(source)))
    steps = steps.withColumn("_value", commune_value(F.col("_raw")))
    steps = steps.withColumn("_key", fold_accents(F.col("_value"))).join(F.broadcast(table), "_key", "left")
    picked = steps.withColumn(target, _commune_pick(F.col("_raw"), F.col("_value"), F.col("_target")))
    return picked.select(*(c for c in df.columns if c != target), target)


def report_region(c: Column) -> Column:
    return F.try_element_at(literal_map({r: r for r in REPORT_REGIONS}), trim_ws(c))


def report_commune(c: Column) -> Column:
    v = trim_ws(c)
    return F.when(v.rlike(_USABLE), v)
