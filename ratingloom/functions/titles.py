"""Column expressions for titles and genre lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: a year in brackets at the very end, and the marker of an item without genres
YEAR_PATTERN = r"\((\d{4})\)$"
YEAR_SUFFIX = r"\s*\(\d{4}\)$"
NO_GENRES = "(no genres listed)"


def year_of(title: Column) -> Column:
    """Release year as int; null when the title does not end with one."""
    return F.regexp_extract(title, YEAR_PATTERN, 1).try_cast("int")


def title_without_year(title: Column) -> Column:
    return F.regexp_replace(title, YEAR_SUFFIX, "")


def genre_list(genres: Column) -> Column:
    """Sorted distinct stripped genres; empty for null, empty or the no-genres marker."""
    tokens = F.transform(F.split(genres, r"\|"), lambda g: F.regexp_replace(g, r"^\s+|\s+$", ""))
    named = genres.isNotNull() & (genres != "") & (genres != NO_GENRES)
    return F.when(named, F.sort_array(F.array_distinct(tokens))).otherwise(F.array().cast("array<string>"))
