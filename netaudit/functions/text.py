"""Columns for sizes, sectioned CSV cells and configuration values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BLANKS = " \t\r\n"


def trim_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def remove_first(text: Column, word: str) -> Column:
    """Remove the first occurrence of a literal word."""
    return F.regexp_replace(text, rf"(?s)^(.*?)\Q{word}\E", "$1")


def config_value(line: Column, key: str) -> Column:
    """Value of a ``set key value`` line: key and quotes removed, trimmed."""
    return trim_blanks(F.translate(remove_first(line, key), '"', ""))


def size_to_mb(text: Column) -> Column:
    """``"1.5 GB"`` as megabytes; null for any other unit."""
    # Megabytes per unit.
    factor = (
        F.when(text.contains("MB"), F.lit(1.0))
        .when(text.contains("GB"), F.lit(1024.0))
        .when(text.contains("TB"), F.lit(1048576.0))
    )
    number = F.trim(F.regexp_replace(text, r"^(.*?)(MB|GB|TB)", "$1"))
    return F.when(number.rlike(r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"), number.try_cast("double")) * factor


def mb_to_gb(mb: Column) -> Column:
    return mb / 1024


def clean_csv_line(line: Column) -> Column:
    """Drop thousands commas, then quotes: quoted fields keep their separating comma."""
    # Fixed value: a comma between digits.
    return F.translate(F.regexp_replace(line, "(?<=[0-9]),(?=[0-9])", ""), '"', "")


def token(parts: Column, position: int) -> Column:
    """One-based token of a split line, null when the line is shorter."""
    return F.try_element_at(parts, F.lit(position))


def name_part(name: Column, position: int) -> Column:
    """Part of a personal name split at a half- or full-width blank."""
    return token(F.split(name, r"[\s　]"), position)
