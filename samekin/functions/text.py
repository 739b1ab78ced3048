"""Text normalization and common beginnings, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the name normalization.
NOT_ALPHANUMERIC = r"[^a-zA-Z0-9\s]"
WHITESPACE_RUN = r"\s+"
NOT_A_LETTER = "[^a-z]"
PREFIX_LENGTH = 3

# Identifiers and types lose leading and trailing control characters too, not only
# spaces.
CONTROL_CHARACTERS = "".join(chr(code) for code in range(0x21))


def normalize_name(name: Column) -> Column:
    """Lower case, no punctuation, single spaces, digit 0 read as letter O, no outer spaces.

    The O is a capital: it is put in after lower-casing, so it never equals a letter.
    """
    stripped = F.regexp_replace(F.lower(name), NOT_ALPHANUMERIC, "")
    return F.trim(F.translate(F.regexp_replace(stripped, WHITESPACE_RUN, " "), "0", "O"))


def trim_control(text: Column) -> Column:
    return F.btrim(text, F.lit(CONTROL_CHARACTERS))


def normalize_wallet(wallet: Column) -> Column:
    return F.lower(trim_control(wallet))


def normalize_type(tx_type: Column) -> Column:
    return F.upper(trim_control(tx_type))


def common_prefix(one: Column, other: Column) -> Column:
    """How many letters two texts begin with in common."""
    shorter = F.least(F.length(one), F.length(other))
    places = F.when(shorter > 0, F.sequence(F.lit(1), shorter)).otherwise(F.array().cast("array<int>"))
    differing = F.filter(places, lambda i: F.substring(one, i, 1) != F.substring(other, i, 1))
    return F.when(F.size(differing) > 0, differing[0] - 1).otherwise(shorter)
