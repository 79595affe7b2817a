"""Column-level building blocks (P*, X*): every function returns a ``Column`` and so
stays inside whole-stage codegen.  No Python UDF anywhere in this module.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The segment-code mapping of the weekly-sales cleaning step.
# First letter of the segment code -> demographic; number -> age band.  The number 4
# maps to "unknown" because the source tests ``= 3 or = 3`` (a typo we keep as the
# default; pass ``age_bands`` to change it).
DEMOGRAPHIC_BY_LETTER = {"C": "Couples", "F": "Families"}
AGE_BAND_BY_NUMBER = {1: "Young Adults", 2: "Middle Aged", 3: "Retirees"}
UNKNOWN = "unknown"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- dates

def parse_dmy_2digit(text: str | Column) -> Column:
    """``to_date(s, 'DD/MM/YY')`` with PostgreSQL's two-digit year rule.

    Day and month may be unpadded (``31/8/20``).  Spark's ``yy`` reads 00-99 as
    2000-2099; PostgreSQL puts 70-99 in the 1900s, so those move back a century.
    """
    d = F.to_date(col_(text), "d/M/yy")
    return F.when(F.year(d) >= 2070, F.add_months(d, -1200)).otherwise(d)


def add_calendar(df: DataFrame, date_col: str, prefix: str = "") -> DataFrame:
    """ISO week, month and calendar year of a date."""
    d = F.col(date_col)
    return df.withColumns(
        {
            f"{prefix}week_number": F.weekofyear(d),
            f"{prefix}month_number": F.month(d),
            f"{prefix}calendar_year": F.year(d),
        }
    )


def day_name(d: str | Column, padded: bool = False) -> Column:
    """``to_char(d, 'day')``: lower-case weekday name, optionally blank-padded to 9."""
    name = F.lower(F.date_format(col_(d), "EEEE"))
    return F.rpad(name, 9, " ") if padded else name


def weekday_monday0(ts: str | Column) -> Column:
    """pandas ``dt.dayofweek``: Monday = 0 ... Sunday = 6."""
    return F.weekday(col_(ts))


def hour_text(ts: str | Column, as_written: bool = False) -> Column:
    """Hour of a timestamp as two digits (X3).  ``as_written`` keeps the leading
    space that slicing the string form ``[10:13]`` produces (``' 08'``)."""
    h = F.date_format(col_(ts), "HH")
    return F.concat(F.lit(" "), h) if as_written else h


def lead_days(later: str | Column, earlier: str | Column) -> Column:
    """Whole days between two timestamps after truncating both to midnight."""
    return F.date_diff(F.to_date(col_(later)), F.to_date(col_(earlier)))


# --------------------------------------------------------------------------- codes

def segment_number(segment: str | Column) -> Column:
    """First run of 1-4 digits in a code, NULL when there is none."""
    return F.regexp_substr(col_(segment), F.lit("[0-9]{1,4}")).cast("int")


def derive_segment(
    df: DataFrame,
    segment_col: str = "segment",
    demographics: Mapping[str, str] = DEMOGRAPHIC_BY_LETTER,
    age_bands: Mapping[int, str] = AGE_BAND_BY_NUMBER,
) -> DataFrame:
    """Split a segment code into number, demographic and age band (DM1)."""
    seg = F.col(segment_col)
    num = segment_number(seg)
    letter = F.substring(seg, 1, 1)
    demo = F.lit(UNKNOWN)
    for k, v in reversed(list(demographics.items())):
        demo = F.when(letter == k, v).otherwise(demo)
    band = F.lit(UNKNOWN)
    for k, v in reversed(list(age_bands.items())):
        band = F.when(num == k, v).otherwise(band)
    return df.withColumns(
        {
            "clean_segment_number": num,
            "demographic_segment": demo,
            "age_band": band,
        }
    )


def flag(c: str | Column, value) -> Column:
    """``(col == value).astype(int)``."""
    return (col_(c) == F.lit(value)).cast("int")


def same_trimmed(a: str | Column, b: str | Column) -> Column:
    """``'1'`` when the trimmed strings are equal, else ``'0'`` (NULL is never equal)."""
    return F.when(F.trim(col_(a)) == F.trim(col_(b)), F.lit("1")).otherwise(F.lit("0"))


# --------------------------------------------------------------------------- bins

def bin_left_closed(x: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``pd.cut(x, edges, right=False)``: ``[e0,e1), [e1,e2) ...``; outside -> NULL."""
    assert len(labels) == len(edges) - 1
    v = col_(x)
    out = F.lit(None).cast("string")
    for lo, hi, lab in reversed(list(zip(edges[:-1], edges[1:], labels))):
        cond = v >= lo
        if hi != float("inf"):
            cond = cond & (v < hi)
        out = F.when(cond, lab).otherwise(out)
    return out


def bin_right_closed(x: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``pd.cut(x, edges)``: ``(e0,e1], (e1,e2] ...``; the lowest edge itself -> NULL."""
    assert len(labels) == len(edges) - 1
    v = col_(x)
    out = F.lit(None).cast("string")
    for lo, hi, lab in reversed(list(zip(edges[:-1], edges[1:], labels))):
        cond = v > lo
        if hi != float("inf"):
            cond = cond & (v <= hi)
        out = F.when(cond, lab).otherwise(out)
    return out


# --------------------------------------------------------------------------- exact arithmetic

def units(c: str | Column, scale: int = 2) -> Column:
    """A decimal with ``scale`` places as an exact integer count of its smallest unit."""
    return (col_(c) * F.lit(10**scale)).cast("decimal(20,0)")


def exact_ratio(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """``num / den`` for two decimals of the given scale, exact to 18 places.

    Dividing the integer unit counts as ``decimal(20,0)`` gives a ``decimal(38,18)``
    quotient, so a later ``F.round`` (HALF_UP on decimals, as PostgreSQL numeric)
    sees the true value; doubles would round ties the binary way.
    """
    d = units(den, scale)
    return F.when(d != 0, units(num, scale) / d)


def exact_pct(num: str | Column, den: str | Column, places: int = 2) -> Column:
    """``round(num / den * 100, places)`` for integer counts, HALF_UP on exact decimals, as double."""
    d = col_(den).cast("decimal(20,0)")
    q = F.when(d != 0, col_(num).cast("decimal(20,0)") / d)
    return F.round(q * 100, places).cast("double")


def exact_round_ratio(num: str | Column, den: str | Column, places: int = 2, scale: int = 0) -> Column:
    """``round(num / den, places)`` HALF_UP on exact decimals, as double."""
    return F.round(exact_ratio(num, den, scale), places).cast("double")


def to_numeric(c: str | Column, coerce: bool = False, to: str = "double") -> Column:
    """``pd.to_numeric(s)`` / ``(s, errors='coerce')`` (P6): a strict cast fails on bad
    text under ANSI mode; ``coerce`` turns bad values into NULL with ``try_cast``."""
    return col_(c).try_cast(to) if coerce else col_(c).cast(to)
