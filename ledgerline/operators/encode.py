"""Data-driven 0/1 columns (P15, D2, EC7).

A dictionary of the levels is built once, from the data the columns are meant for, and
used for every table that gets them, so tables keep the same columns:

* names are ``prefix`` plus the level in lower case; levels whose names collide (they differ
  in case only) share one column, 1 for any of them;
* a level that the dictionary does not know, and NULL, has zeros everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most levels of a dictionary; a column with more is no category.
MOST_LEVELS = 2000


def category_dictionary(df: DataFrame, column: str, prefix: str = "is_", most: int = MOST_LEVELS) -> dict[str, list[str]]:
    """``{flag name: levels}`` of a string column, by one distinct aggregate; at most ``most`` levels reach the driver."""
    levels = [r[0] for r in df.select(column).distinct().filter(F.col(column).isNotNull()).limit(most + 1).collect()]
    if len(levels) > most:
        raise ValueError(f"{column} has more than {most} levels")
    out: dict[str, list[str]] = {}
    for level in sorted(levels):
        out.setdefault(f"{prefix}{level.lower()}", []).append(level)
    return out


def one_hot(df: DataFrame, column: str, dictionary: dict[str, list[str]]) -> DataFrame:
    """``df`` with an int column 0/1 for each entry of the dictionary; one ``select``, no shuffle."""
    clash = set(dictionary) & set(df.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    return df.select("*", *[F.coalesce(F.col(column).isin(levels), F.lit(False)).cast("int").alias(name) for name, levels in dictionary.items()])


def flag_totals(df: DataFrame, names: list[str]) -> DataFrame:
    """``flag, n_ones, n_rows``, one row per 0/1 column, from one aggregate."""
    if not names:
        return df.sparkSession.createDataFrame([], "flag string, n_ones long, n_rows long")
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(F.col(f"`{c}`")).alias(f"_s{i}") for i, c in enumerate(names)])
    cells = F.array(*[F.struct(F.lit(c).alias("flag"), F.coalesce(f"_s{i}", F.lit(0)).alias("n_ones"), F.col("_n").alias("n_rows")) for i, c in enumerate(names)])
    return one.select(F.explode(cells).alias("_c")).select("_c.*")
