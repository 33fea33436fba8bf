"""Identifier tokens, rounding and one-hot columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from thermoloom.functions.calendar import SEASON_MONTHS

#: Position of the running number in an ``_``-separated identifier.
ID_TOKEN = 6


def id_token(identifier: Column, strict: bool = True) -> Column:
    """The identifier's number as text; too few parts raise, or give NULL."""
    parts = F.split(identifier, "_")
    return parts[ID_TOKEN] if strict else F.get(parts, F.lit(ID_TOKEN))


def id_number(identifier: Column, strict: bool = True) -> Column:
    token = id_token(identifier, strict)
    return token.cast("bigint") if strict else token.try_cast("bigint")


def known(number: Column) -> Column:
    """NaN and infinite numbers become NULL, so that aggregates skip them."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Share in percent, ties to even."""
    return F.bround(part / whole * 100, digits)


def season_flags(season: str) -> dict[str, Column]:
    """One 0/1 column per label of the fixed season domain."""
    return {
        f"season_{label}": F.expr(f"CASE WHEN {season} = '{label}' THEN 1 ELSE 0 END")
        for label in sorted(SEASON_MONTHS)
    }
