"""Column expressions over text: keys, status words, numbers in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status words and boolean words of the exports.
OCCUPIED_WORDS = ["present", "occupied", "1", "true"]
VACANT_WORDS = ["notpresent", "vacant", "0", "false"]
TRUE_WORDS = ["true", "1", "yes"]
FALSE_WORDS = ["false", "0", "no"]

NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_double(value: Column) -> Column:
    """Number in text to double; anything else, `nan` and `12d` included, is null."""
    text = value.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def round_id(value: Column) -> Column:
    """Identifier that was read as a float: half goes to the even neighbour."""
    return F.rint(to_double(value)).try_cast("bigint")


def trim_key(value: Column) -> Column:
    """Key as text without outer blanks; null stays null."""
    return F.trim(value.cast("string"))


def canonical_id(value: Column) -> Column:
    """Upper case, every run of white space one blank."""
    return F.regexp_replace(F.upper(value.cast("string")), r"\s+", " ")


def status_norm(value: Column) -> Column:
    return F.lower(F.trim(value.cast("string")))


def occupied_flag(status: Column, unknown: int | None = None) -> Column:
    """1 for the occupied words, 0 for the vacant ones, `unknown` for the rest and null."""
    word = status_norm(status)
    return (
        F.when(word.isin(OCCUPIED_WORDS), F.lit(1))
        .when(word.isin(VACANT_WORDS), F.lit(0))
        .otherwise(F.lit(unknown).cast("int"))
    )


def truth(value: Column) -> Column:
    """Boolean word to boolean, unknown words to null."""
    word = F.lower(value.cast("string"))
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)
