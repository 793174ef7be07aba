"""Column resolution and cleaning expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F


def first_present(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """First candidate that is a column of ``df`` (exact spelling)."""
    present = set(df.columns)
    return next((c for c in candidates if c in present), None)


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def rename_synonyms(df: DataFrame, synonyms: Mapping[str, Iterable[str]]) -> DataFrame:
    """Rename each column that is a known synonym to its canonical name.

    When several columns are synonyms of one name, the canonical spelling wins,
    then the earliest synonym in the list; the others stay as they are.
    """
    taken = set(df.columns)
    renames: dict[str, str] = {}
    for canonical, names in synonyms.items():
        if canonical in taken:
            continue
        source = first_present(df, names)
        if source is not None:
            renames[source] = canonical
    return df.withColumnsRenamed(renames) if renames else df


def text_to_double(c: Column | str) -> Column:
    """Number written with a decimal comma and blanks; NULL when unreadable."""
    text = F.col(c) if isinstance(c, str) else c
    cleaned = F.replace(F.replace(text, F.lit(","), F.lit(".")), F.lit(" "), F.lit(""))
    return cleaned.try_cast("double")


def truthy(c: Column | str) -> Column:
    """1 for the texts that mean yes, else 0."""
    text = F.col(c) if isinstance(c, str) else c
    # fixed values: accepted spellings of yes
    yes = ["да", "true", "1", "yes"]
    return F.coalesce(F.lower(text.cast("string")).isin(yes), F.lit(False)).cast("int")


def finite_or_null(c: Column | str) -> Column:
    """NaN and both infinities become NULL; NaN compares as the largest number."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(F.abs(col) < F.lit(float("inf")), col)


def iso_weekday(c: Column | str) -> Column:
    """Monday = 1 … Sunday = 7."""
    return F.weekday(c) + F.lit(1)
