"""Date and time parsing. The lenient form gives null for text that does not parse; `strict` raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strftime directive -> Spark datetime letters. Single letters, since strptime accepts one or two
# digits for day, month, hour, minute and second.
STRFTIME = {
    "d": "d",
    "m": "M",
    "Y": "yyyy",
    "b": "MMM",
    "B": "MMMM",
    "H": "H",
    "I": "h",
    "M": "m",
    "S": "s",
    "p": "a",
    "j": "D",
}


def spark_pattern(strftime: str) -> str:
    """Translate a strftime format into a Spark datetime pattern, quoting literal letters."""
    out, i = [], 0
    while i < len(strftime):
        ch = strftime[i]
        if ch == "%":
            i += 1
            directive = strftime[i : i + 1]
            if directive == "%":
                out.append("%")
            elif directive in STRFTIME:
                out.append(STRFTIME[directive])
            else:
                raise ValueError(f"unsupported directive %{directive} in {strftime!r}; known: {sorted(STRFTIME)}")
        elif ch.isalpha():
            out.append(f"'{ch}'")
        elif ch == "'":
            out.append("''")
        else:
            out.append(ch)
        i += 1
    return "".join(out)


def parse_date(text: Column, strftime: str = "%d/%m/%Y", strict: bool = False) -> Column:
    pattern = spark_pattern(strftime)
    return F.to_date(text, pattern) if strict else F.try_to_date(text, pattern)


def parse_timestamp(text: Column, strftime: str = "%Y-%m-%d %H:%M:%S", strict: bool = False) -> Column:
    """Wall-clock timestamp without a zone."""
    pattern = spark_pattern(strftime)
    parsed = F.to_timestamp(text, pattern) if strict else F.try_to_timestamp(text, F.lit(pattern))
    return parsed.cast("timestamp_ntz")


def parse_time_of_day(text: Column, strftime: str = "%H:%M:%S", strict: bool = False) -> Column:
    """Time of day as a wall-clock timestamp on 1970-01-01."""
    return parse_timestamp(text, strftime, strict)


def strip_ordinal(text: Column) -> Column:
    """`Nov 18th 2024` -> `Nov 18 2024`."""
    return F.regexp_replace(text, r"(\d+)(st|nd|rd|th)", "$1")


def parse_listing_time(text: Column) -> Column:
    """Listing timestamps such as `Nov 18th 2024, 10:05:07 AM`."""
    return parse_timestamp(strip_ordinal(text), "%b %d %Y, %I:%M:%S %p")
