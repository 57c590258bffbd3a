"""String helpers for waves, file names and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wave_year(wave: Column) -> Column:
    """`2018 Q2 spring (Apr-Jun)` -> `2018`."""
    return F.split_part(wave, F.lit(" "), F.lit(1))


def wave_quarter(wave: Column) -> Column:
    """`2018 Q2 spring (Apr-Jun)` -> `Q2`."""
    return F.split_part(F.split_part(wave, F.lit(" "), F.lit(2)), F.lit("("), F.lit(1))


def normalise_name(name: Column) -> Column:
    """A table or topic name: spaces become underscores, parentheses go."""
    return F.translate(name, " ()", "_")


def quote_spaces(name: Column) -> Column:
    return F.replace(name, F.lit(" "), F.lit("%20"))


def contains_ci(text: Column, part: str) -> Column:
    return F.lower(text).contains(part.lower())


def file_name(year: Column, quarter: Column, season: Column, months: Column, place: Column) -> Column:
    """`{year} {quarter}[ season] {months}-{place}.csv`; no season when it is null or empty."""
    spaced = F.when(F.coalesce(season, F.lit("")) != "", F.concat(F.lit(" "), season)).otherwise("")
    return F.concat(year, F.lit(" "), quarter, spaced, F.lit(" "), months, F.lit("-"), place, F.lit(".csv"))


# year, quarter, optional season, bracketed months (or a remark such as "synthetic"), place
FILE_NAME = r"^(\d{4}) (Q[1-4])(?: ([a-z]+))? (\([^)]*\))-(.+)\.csv$"


def file_name_parts(name: Column) -> dict[str, Column]:
    """Columns read back out of a file name; all null when the name has another shape."""
    fits = name.rlike(FILE_NAME)

    def part(i: int) -> Column:
        return F.when(fits, F.regexp_extract(name, FILE_NAME, i))

    return {
        "year": part(1),
        "quarter": part(2),
        "season": F.nullif(part(3), F.lit("")),
        "months": part(4),
        "place": part(5),
        "dir_path": F.concat(part(1), F.lit("/"), part(2), F.lit("-"), part(4)),
    }


def label_replace(current: Column, source: Column, regex: str, replacement: str) -> Column:
    """`replacement` with $1.. taken from `source` when the whole of it matches, else `current`."""
    whole = f"^(?:{regex})$"
    return F.when(source.rlike(whole), F.regexp_replace(source, whole, replacement)).otherwise(current)
