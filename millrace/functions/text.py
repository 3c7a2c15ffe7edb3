"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_part(path: Column, index: int, separator: str = "/") -> Column:
    """The index-th part of a separated path; null when the path has fewer parts."""
    return F.get(F.split(path, separator), F.lit(index))


def decimal_text(number: Column) -> Column:
    """Double from text that may use a decimal comma; null when it is not a number."""
    return F.replace(number, F.lit(","), F.lit(".")).try_cast("double")


def first_name_token(name: Column) -> Column:
    """Letters of the first word of a name, where a capital also starts a word."""
    spaced = F.regexp_replace(name, "([A-Z])", " $1")
    return F.regexp_replace(F.regexp_extract(spaced, r"\S+", 0), "[^a-zA-Z]+", "")


def uuid_hex() -> Column:
    """Random 32-digit hex id."""
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))
