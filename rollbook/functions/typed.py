"""Typed readings of fields that are stored as text. Opt-in: the tables themselves keep the text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def compact_date(c: Column) -> Column:
    """``YYYYMMDD`` as a date, null if it is not one."""
    return F.when(c.rlike(r"^\d{8}$"), F.try_to_timestamp(c, F.lit("yyyyMMdd")).cast("date"))


def yes_no(c: Column) -> Column:
    """``S`` is true, ``N`` is false, anything else null."""
    return F.when(c == "S", True).when(c == "N", False)


def comma_money(c: Column) -> Column:
    """``1234,56`` as a decimal, null if it is not a number."""
    return F.regexp_replace(c, ",", ".").try_cast("decimal(18,2)")
