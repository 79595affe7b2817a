"""Scans and sinks.

Everything here is lazy: a loader returns DataFrames whose scans Catalyst prunes
(``ReadSchema``) and filters (``PushedFilters``) once a query uses them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.session import written

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_tables(spark: SparkSession, sf_dir: str, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """``{name: DataFrame}`` for a directory of parquet tables (S1 with parquet instead of CSV)."""
    return {n: load_table(spark, sf_dir, n) for n in (names or TEST_TABLES)}


def read_csv_set(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str,
    source_col: str | None = "source_file",
) -> DataFrame:
    """Many header CSV files of one table read as a single scan.

    One ``spark.read.csv`` over all paths (or a glob) replaces a union of per-file
    frames; the file each row came from is kept from ``_metadata`` so a monthly
    partition file can still be told apart.  An explicit schema replaces inference,
    so nothing is read twice and types do not drift between files.
    """
    df = spark.read.option("header", True).option("mode", "FAILFAST").schema(schema).csv(
        list(paths) if not isinstance(paths, str) else paths
    )
    if source_col:
        df = df.withColumn(source_col, F.col("_metadata.file_name"))
    return df


REJECTED = "_rejected"


def read_csv_with_rejects(spark: SparkSession, paths: str | Sequence[str], schema: str, header: bool = True) -> DataFrame:
    """A CSV set whose malformed lines stay visible: ``_rejected`` holds a line that does not fit ``schema`` (wrong number
    of fields, a value of another type), and is NULL for the others; ``source_file`` is the file's name.

    The parser converts only the columns that a query reads, so whether a line is rejected would depend on the query.
    All columns are therefore parsed once and written to the shared folder; what is returned reads that.
    """
    df = spark.read.options(header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED)
    df = df.schema(f"{schema}, {REJECTED} string").csv(list(paths) if not isinstance(paths, str) else paths)
    return written(df.withColumn("source_file", F.col("_metadata.file_name")), "parsed")


def rejects_by_file(df: DataFrame, by: str = "source_file") -> DataFrame:
    """``n_lines, n_rejected, n_kept`` per file (or per ``by``)."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count(REJECTED).alias("n_rejected"),
        F.count_if(F.col(REJECTED).isNull()).alias("n_kept"),
    )


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Persist a cleaned table, replacing the old one (S5: a materialized view as a written table)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV sink.

    ``single_file`` is only for small summaries (a few hundred rows); large tables
    keep their partitioning so the write stays parallel.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
