"""The stateless web-event steps on a streaming DataFrame.

The reference keeps no streaming state, so nothing here is a streaming operator of
its own: the event enrichment (cookie, visit, page, event type -> name) is the same
DataFrame code as the batch path, applied to a ``readStream`` source, with
stream-static broadcast joins to the small lookups.  Per-visit counts are kept in
the sink with ``foreachBatch`` or, for tests, the ``memory`` sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans.standins import EVENT_TYPE_BY_KIND, event_names, page_hierarchy
from ledgerline.sources.tables import load_table


def read_event_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    """The ``events`` parquet file of a test directory as a file stream."""
    schema = load_table(spark, sf_dir, "events").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(sf_dir)
    )


def enrich_events(raw: DataFrame) -> DataFrame:
    """Raw events -> cookie, visit, page and named event (the batch stand-in's steps)."""
    spark = raw.sparkSession
    cookie = F.concat(F.lit("c"), F.col("user_id").cast("string"))
    kind = F.lit(None).cast("int")
    for k, v in reversed(list(EVENT_TYPE_BY_KIND.items())):
        kind = F.when(F.col("event_type") == k, F.lit(v)).otherwise(kind)
    e = raw.select(
        "event_id",
        cookie.alias("cookie_id"),
        F.concat(cookie, F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("visit_id"),
        (F.get_json_object("props", "$.k").cast("int") % 13 + 1).alias("page_id"),
        kind.alias("event_type"),
        F.col("ts").alias("event_time"),
    )
    # lookups are literal tables of 5 and 13 rows: broadcast stream-static joins
    e = e.join(F.broadcast(event_names(spark)), "event_type")
    return e.join(F.broadcast(page_hierarchy(spark).select("page_id", "page_name")), "page_id", "left")


def event_counts_to_memory(spark: SparkSession, sf_dir: str, name: str = "event_counts"):
    """Start a streaming count of events per name into the in-memory table ``name``
    (complete mode) and return the query handle."""
    counts = enrich_events(read_event_stream(spark, sf_dir)).groupBy("event_name").agg(
        F.count(F.lit(1)).alias("n_events")
    )
    return counts.writeStream.outputMode("complete").format("memory").queryName(name).start()
