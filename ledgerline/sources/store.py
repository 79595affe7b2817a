"""Written tables that queries share (S5, EC13): versions in the shared folder behind one name.

A version is a catalogued, partitioned Parquet table of its own in the folder of ``spark.checkpoint.dir``.  The name is a view of the current
version: writing a new one and replacing the view are separate steps, and the second is a single
entry in the catalog.  A failed write therefore leaves the old table in place, readers see the old
version or the new one, never a part, and scans keep partition and column pruning.
The version before the current one stays in the catalog for queries under way; older ones are dropped from it. Files
are left to whoever clears the shared folder.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import ensure_checkpoint_dir


def versions(spark: SparkSession, name: str) -> list[str]:
    """The version tables of ``name``, oldest first."""
    found = [t.name for t in spark.catalog.listTables(pattern=f"{name}__v*") if not t.isTemporary]
    return sorted(found, key=lambda t: int(t.split("__v")[1].split("_")[0]))


def replace_table(spark: SparkSession, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as the new content of ``name`` and return the table."""
    old = versions(spark, name)
    number = int(old[-1].split("__v")[1].split("_")[0]) + 1 if old else 1
    new = f"{name}__v{number}_{uuid.uuid4().hex[:8]}"
    folder = ensure_checkpoint_dir(spark).rstrip("/")
    writer = df.write.format("parquet").option("path", f"{folder}/tables/{new}")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(new)
    columns = ", ".join(f"`{c}`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {new}")
    for table in old[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return spark.table(name)


def table_name(name: str, sf_dir: str) -> str:
    """The name of a table that is derived from the inputs in ``sf_dir``."""
    return f"{name}_{hashlib.md5(sf_dir.rstrip('/').encode()).hexdigest()[:12]}"


def shared_table(spark: SparkSession, name: str, sf_dir: str, build: Callable[[], DataFrame],
                 partition_by: Sequence[str] = ()) -> DataFrame:
    """The table ``name`` for ``sf_dir``: read if the catalog has it, else built and written first.

    Like a materialized view it shows its inputs as they were when it was written; ``refresh`` writes it anew.
    """
    own = table_name(name, sf_dir)
    return spark.table(own) if spark.catalog.tableExists(own) else replace_table(spark, own, build(), partition_by)


def refresh(spark: SparkSession, name: str, sf_dir: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = ()) -> DataFrame:
    return replace_table(spark, table_name(name, sf_dir), build(), partition_by)
