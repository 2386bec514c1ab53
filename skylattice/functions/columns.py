"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def quoted(name: str) -> str:
    """A column name as SQL text, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def seconds_between(start: str, end: str) -> str:
    """SQL text: whole seconds from one timestamp column to another.

    The cast floors to seconds, also before 1970.
    """
    return f"(cast({quoted(end)} as bigint) - cast({quoted(start)} as bigint))"


def time_cell(timestamp: str, width_seconds: int) -> Column:
    """Start (epoch seconds) of the fixed-width cell that holds ``timestamp``.

    Two rows of one cell are at most ``width_seconds - 1`` seconds apart.
    """
    seconds = f"cast({quoted(timestamp)} as bigint)"
    return F.expr(f"{seconds} - pmod({seconds}, {width_seconds}L)")


def calendar_columns(timestamp: str) -> dict[str, Column]:
    """``date, hour, year, month, day`` in the session's time zone."""
    part = {
        "date": "to_date",
        "hour": "hour",
        "year": "year",
        "month": "month",
        "day": "dayofmonth",
    }
    return {name: F.expr(f"{call}({quoted(timestamp)})") for name, call in part.items()}


def airline_key(callsign: str) -> Column:
    """Operator prefix of a call sign: its first three letters, upper case.

    Any three-letter prefix counts, registrations included; a blank call sign
    gives an empty key, which no airline carries.
    """
    return F.expr(f"upper(substring(trim({quoted(callsign)}), 1, 3))")


def label_or(column: str, fallback: str) -> Column:
    """Trimmed text, or ``fallback`` where it is NULL or blank."""
    return F.coalesce(F.expr(f"nullif(trim({quoted(column)}), '')"), F.lit(fallback))
